"""Trial history derived from the events table: study = event type, loss = value."""

from pyspark.sql import functions as F

TRIALS = """SELECT event_type AS study, event_id AS number, value AS loss, user_id, (props::JSON->>'k')::INT AS k,
  CASE WHEN event_id % 11 = 0 THEN 'FAIL' WHEN event_id % 7 = 0 THEN 'PRUNED' ELSE 'COMPLETE' END AS state FROM events"""


def trials(t):
    k = F.get_json_object("props", "$.k")
    state = F.when(F.col("event_id") % 11 == 0, "FAIL").when(F.col("event_id") % 7 == 0, "PRUNED").otherwise("COMPLETE")
    return t.events.select(
        F.col("event_type").alias("study"), F.col("event_id").alias("number"), F.col("value").alias("loss"),
        F.create_map(F.lit("user"), F.col("user_id").cast("string"), F.lit("k"), k).alias("params"),
        F.col("user_id"), k.cast("int").alias("k"), state.alias("state"))
