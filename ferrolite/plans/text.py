"""Queries: text features over documents and labels."""

from pyspark.sql import functions as F

from ..functions.cols import r, vec_to_array
from ..functions.hashing import unit_draw
from ..functions.layout import spread
from ..operators import text as X
from .registry import query

TOK = r"SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: w <> '') AS tokens FROM documents"
TF = f"SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM ({TOK})) GROUP BY 1, 2"
# A short stop list for the test corpus.
STOP = ["the", "and", "of", "in", "to", "le", "la", "de", "und", "der", "die", "el", "los"]


def docs(t, *more):
    return X.tokenize(spread(t.documents.select("doc_id", "text", *more))).drop("text")


@query("word_count", "G1", sql=f"SELECT doc_id, len(tokens)::INT AS word_count, round(CASE WHEN len(tokens) = 0 THEN 0 ELSE list_sum(list_transform(tokens, lambda w: length(w))) / len(tokens) END, 2)::DOUBLE AS mean_word_length FROM ({TOK})")
def _(t):
    return X.mean_word_length(X.word_count(t.documents.select("doc_id", "text"))).drop("text")


@query("tokenize", "G2", sql=f"SELECT doc_id, len(tokens)::INT AS n, md5(array_to_string(tokens, ' ')) AS digest FROM ({TOK})")
def _(t):
    return docs(t).select("doc_id", F.size("tokens").alias("n"), F.md5(F.array_join("tokens", " ")).alias("digest"))


@query("sentences", "G3", sql=r"""WITH s AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[.!?]+\s*'), lambda x: x <> '') AS p FROM documents),
  u AS (SELECT doc_id, unnest(range(0, len(p))) AS i, unnest(p) AS sentence FROM s)
  SELECT doc_id, i::INT AS sentence_no, md5(sentence) AS digest, len(list_filter(regexp_split_to_array(lower(sentence), '\s+'), lambda w: w <> ''))::INT AS n_words FROM u""")
def _(t):
    return X.sentences(t.documents, "doc_id").select("doc_id", "sentence_no", F.md5("sentence").alias("digest"), "n_words")


@query("remove_stopwords", "G4", sql=f"SELECT doc_id, md5(array_to_string(list_filter(tokens, lambda w: NOT list_contains({STOP}, w)), ' ')) AS digest FROM ({TOK})")
def _(t):
    return X.remove_stopwords(docs(t), "tokens", STOP).select("doc_id", F.md5(F.array_join("tokens", " ")).alias("digest"))


@query("hashing_tf", "G5")
def _(t):
    df = X.hashing_tf(docs(t), 256)
    return vec_to_array(df.select("doc_id", "tf"), "tf")


@query("count_vectorize", "G6", sql=f"WITH c AS ({TF}), v AS (SELECT term, count(*) AS df FROM c GROUP BY 1 HAVING count(*) >= 3) SELECT doc_id, term, tf, df FROM c JOIN v USING (term)")
def _(t):
    return X.count_vectorize(docs(t), "doc_id", min_df=3)


@query("count_vectors", "G6")
def _(t):
    return vec_to_array(X.count_vectors(docs(t), 100, 2.0).select("doc_id", "counts"), "counts")


TFIDF = f"""c AS ({TF}), v AS (SELECT term, count(*) AS df FROM c GROUP BY 1 HAVING count(*) >= 2 AND count(*) <= 0.5 * (SELECT count(*) FROM documents)),
  raw AS (SELECT doc_id, term, (1 + ln(tf)) * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w FROM c JOIN v USING (term)),
  tfidf AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""


def weights(t):
    return X.tf_idf(docs(t), "doc_id", min_df=2, max_df=0.5)


@query("tf_idf", "G7", sql=f"WITH {TFIDF} SELECT doc_id, term, round(weight, 9) AS weight FROM tfidf")
def _(t):
    return weights(t).withColumn("weight", r(F.col("weight"), 9))


@query("tf_idf_top_vocabulary", "G7", sql=f"""WITH c AS ({TF}), v AS (SELECT term, count(*) AS df FROM c GROUP BY 1 ORDER BY sum(tf) DESC, term LIMIT 200)
   SELECT doc_id, term, round(tf * (ln((SELECT count(*) FROM documents) / df) + 1), 9) AS weight FROM c JOIN v USING (term)""")
def _(t):
    out = X.tf_idf(docs(t), "doc_id", sublinear=False, smooth=False, max_features=200, l2=False)
    return out.withColumn("weight", r(F.col("weight"), 9))


@query("strip_accents", "G8", sql="SELECT doc_id, md5(strip_accents(text)) AS digest FROM documents")
def _(t):
    return X.strip_accents(t.documents, "text").select("doc_id", F.md5("text").alias("digest"))


@query("top_terms_doc", "G9", sql=f"WITH {TFIDF} SELECT doc_id, term, round(weight, 9) AS weight, rank FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(weight, 9) DESC, term)::INT AS rank FROM tfidf) WHERE rank <= 5")
def _(t):
    return X.top_terms_doc(weights(t).withColumn("weight", r(F.col("weight"), 9)), "doc_id", 5)


@query("top_terms_by_class", "G10", sql=f"""WITH {TFIDF}, m AS (SELECT lang, term, round(sum(weight) / max(n), 9) AS mean_weight FROM tfidf JOIN documents USING (doc_id)
   JOIN (SELECT lang, count(*) AS n FROM documents GROUP BY 1) USING (lang) WHERE weight >= 0.1 GROUP BY 1, 2)
   SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY mean_weight DESC, term)::INT AS rank FROM m) WHERE rank <= 10""")
def _(t):
    return X.top_terms_by_class(weights(t), t.documents.select("doc_id", "lang"), "doc_id", "lang")


@query("svd", "G11")
def _(t):
    factors, _values = X.svd(X.hashing_tf(docs(t), 64), "tf", 4, "doc_id")
    return factors.select("doc_id", F.transform("factors", lambda x: r(F.abs(x), 4)).alias("factors"))


@query("word2vec", "G12")
def _(t):
    model = X.word2vec(docs(t), 16)
    return vec_to_array(model.transform(docs(t)).select("doc_id", "embedding"), "embedding")


VECTORS = f"""SELECT term, [{', '.join(f"('0x' || substr(md5('{i}|' || term), 1, 8))::BIGINT / 4294967296.0::DOUBLE" for i in range(4))}] AS vector
   FROM (SELECT term FROM ({TF}) GROUP BY term HAVING count(*) >= 10)"""


@query("mean_embedding", "G13", sql=f"""WITH x AS (SELECT doc_id, tf, vector FROM ({TF}) JOIN ({VECTORS}) USING (term))
   SELECT d.doc_id, [{', '.join(f'round(coalesce(sum(tf * vector[{i}]) / sum(tf), 0), 9)' for i in range(1, 5))}] AS embedding FROM documents d LEFT JOIN x ON x.doc_id = d.doc_id GROUP BY 1""")
def _(t):
    df = docs(t)
    frequent = X.term_counts(df, "doc_id").groupBy("term").agg(F.count(F.lit(1)).alias("n")).where("n >= 10")
    vectors = frequent.select("term", F.array(*[unit_draw(i, "term") for i in range(4)]).alias("vector"))
    out = X.mean_embedding(df, vectors, "doc_id", 4)
    return out.select("doc_id", F.transform("embedding", lambda x: r(x, 9)).alias("embedding"))


SEQ = f"""v AS (SELECT term, row_number() OVER (ORDER BY sum(tf) DESC, term)::INT AS rank FROM ({TF}) GROUP BY 1 ORDER BY rank LIMIT 100),
   w AS (SELECT doc_id, unnest(tokens) AS term, unnest(range(0, len(tokens))) AS pos FROM ({TOK})),
   s AS (SELECT doc_id, list(rank ORDER BY pos) AS sequence FROM w JOIN v USING (term) GROUP BY 1)"""


@query("texts_to_sequences", "G14", sql=f"WITH {SEQ} SELECT d.doc_id, coalesce(sequence, []::INT[]) AS sequence FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id")
def _(t):
    return X.texts_to_sequences(docs(t), "doc_id", 100)


@query("pad_sequences", "G15", sql=f"""WITH {SEQ}, q AS (SELECT d.doc_id, coalesce(sequence, []::INT[]) AS sequence FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id)
   SELECT doc_id, list_concat(list_transform(range(0, greatest(20 - len(sequence), 0)), lambda i: 0::INT), sequence[greatest(len(sequence) - 20, 0) + 1:]) AS sequence FROM q""")
def _(t):
    return X.pad_sequences(X.texts_to_sequences(docs(t), "doc_id", 100), "sequence", 20)


@query("text_featurizer", "G16")
def _(t):
    df = t.documents.select("doc_id", "text")
    return vec_to_array(X.text_featurizer(n=128).fit(df).transform(df).select("doc_id", "features"), "features")


@query("short_texts", "G17", sql=f"SELECT doc_id, len(tokens)::INT AS word_count FROM ({TOK}) WHERE len(tokens) < 12")
def _(t):
    return X.short_texts(t.documents, 12).select("doc_id", "word_count")


@query("duplicate_texts", "G18", sql="""SELECT md5(text) AS digest, count(DISTINCT doc_id) AS n, min(doc_id) AS first_key, count(DISTINCT quality) <= 1 AS labels_agree
   FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1 HAVING count(DISTINCT doc_id) > 1""")
def _(t):
    return X.duplicate_texts(t.documents.join(t.labels, "doc_id", "left"), "doc_id", label="quality")


@query("annotate_tokens", "G19", sql=f"SELECT doc_id, md5(array_to_string(list_transform(tokens, lambda w: CASE WHEN length(w) > 8 THEN w || '[LONG]' ELSE w END), ' ')) AS digest FROM ({TOK})")
def _(t):
    tags = F.transform("tokens", lambda w: F.when(F.length(w) > 8, "LONG").otherwise("O"))
    return X.annotate_tokens(docs(t).withColumn("tags", tags), "tokens", "tags").select("doc_id", F.md5("annotated").alias("digest"))
