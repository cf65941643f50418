"""Personal data by candidates and gradient boosting, by DataFrame functions and Spark ML only.

Base spans follow fixed patterns and checks, leftmost and without overlap within a kind; they always stay. High-recall
generators propose further spans that may overlap: addresses written with words or brackets for signs, digit groups of
many shapes, dotted or colon-separated numbers. Boosted trees judge each candidate by what it says, whatever signs it is
written with, and by the text around it. They are taught on base spans, and on some made-up ones, rewritten into the
generators' other shapes; counterexamples are candidates that fail a check or are another kind's base span, and rewritten
numbers, dates, versions, ids and prose. Candidates that no check decides teach nothing. The trees are compiled into a column
expression over the candidates of a row, so nothing is exploded or shuffled to be scored. Isotonic regression on candidates left out of the training turns margins into
probabilities, and each generator's threshold is the least that keeps the left-out precision at `PRECISION`.

The fit uses every candidate that a check decides and every span's other shapes. Candidates that look alike to the trees are one row with their number as its weight,
so the passes of the training go over distinct rows, and bins are as many as it takes for Spark to place splits without sampling them. Positions are code points, ends exclusive.
Work on a text grows with its length and its matches: running sums and greatest ends are worked out in runs, substrings from pieces of the text.
Null texts count as empty. Tables without candidates train no trees; then the base spans are all there is. Extra columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import isqrt

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F

from .common import Scratch
from .trees import margin_sql

KINDS = ["email", "ip", "card", "phone"]
#: The base patterns, written so that Java's engine scans once: possessive where nothing could be given back, and runs
#: entered only at their start or where the last match ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERATORS = {
    "email": r"(?i)(?:\G|(?<![a-z0-9._%+-]))[a-z0-9._%+-]++(?:@|\x20?[\[({](?:at|@)[\])}]\x20?|\x20at\x20(?=[a-z0-9-]++(?:\x20dot\x20|\.)[a-z]))[a-z0-9-]++(?:(?:\.|\x20?[\[({](?:dot|\.)[\])}]\x20?|\x20dot\x20)[a-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9A-Fa-f:.]))(?:[0-9]++(?:[.][0-9]++){2,7}+|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7}+)",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20./_-]{0,2}[0-9]){11,}+",
    "phone": r"(?:\G|(?<![0-9]))(?:\+|\(|00)?[0-9](?:[\x20()./-]{0,2}[0-9]){6,}+",
}
#: What every match of a pattern holds, quick to look for, so that most texts are passed over.
BASE_NEEDS = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
NEEDS = {"email": r"@|(?i)[\[({]at[\])}]|\x20at\x20[a-z0-9-]++(?:\x20dot\x20|\.[a-z])", "ip": "[0-9:]", "card": "[0-9]", "phone": "[0-9]"}
FEATURES = ["digits", "groups", "long_group", "first_group", "last_group", "first_digit", "luhn", "octets", "hextets", "dated", "book", "labels", "top_label", "prose", "file",
            "before_word", "after_word", "hint_mail", "hint_phone", "hint_card", "hint_ip", "hint_secret", "hint_id", "line_start"]
HINTS = {
    "hint_mail": r"(?i)mail|contact|write|kontakt|correo|courriel", "hint_phone": r"(?i)tel|phone|call|mobil|fax|anruf|llam",
    "hint_card": r"(?i)card|visa|karte|carte|tarjeta|pay", "hint_ip": r"(?i)\bip\b|host|addr|server", "hint_secret": r"(?i)token|passw|key|secret|[=\"]\s?$",
    "hint_id": r"(?i)\b(?:item|id|order|no|ref|isbn|version|release|serial|invoice)\b\W*$|#$",
}
ROUNDS, DEPTH = 16, 3
PRECISION = 0.95
AROUND = 24
TASK_ROWS = 1 << 14


RUN = 256
PIECE = 1024


def let(value: Column, use) -> Column:
    """use(value), with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def stretch(items: Column, first: Column, last: Column) -> Column:
    """Items first to last, counted from 0, one by one: slice() reads the whole array each time."""
    return F.transform(F.sequence(first, last), lambda i: F.get(items, i))


def scanned(values: Column, merge) -> Column:
    """Each number of an array merged with all before it; merge is associative.

    A running array is copied at each item, so it only grows over a run of RUN items, and once over the runs' ends."""
    def plain(items):
        return F.aggregate(items, F.array().cast("array<int>"), lambda out, x: F.concat(out, F.array(F.coalesce(merge(F.try_element_at(out, F.lit(-1)), x), x))))

    def cut(items):
        runs = F.filter(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / RUN).cast("int")), lambda i: (i >= 0) & (i * RUN < F.size(items)))
        return F.transform(runs, lambda i: plain(stretch(items, i * RUN, F.least(i * RUN + RUN, F.size(items)) - 1)))

    def joined(runs):
        before = plain(F.transform(runs, lambda x: F.element_at(x, -1)))
        return let(before, lambda b: F.flatten(F.transform(runs, lambda x, i: F.transform(x, lambda v: F.coalesce(merge(F.get(b, i - 1), v), v)))))

    return let(values, lambda items: let(cut(items), joined))


def located(text: Column, pattern: str) -> Column:
    """Array of (start, end, found) of all matches: what lies between them gives the places."""
    def placed(found):
        widths = F.zip_with(found, F.slice(F.split(text, pattern, -1), 1, F.size(found)), lambda m, gap: F.length(gap) + F.length(m))
        ends = let(widths, lambda w: scanned(w, lambda a, b: a + b))
        return F.zip_with(found, ends, lambda m, end: F.struct((end - F.length(m)).alias("start"), end.alias("end"), m.alias("found")))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def in_pieces(text: Column) -> Column:
    """The text in pieces of PIECE characters: a substring of a long text is looked for from its beginning each time."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def between(pieces: Column, start: Column, end: Column) -> Column:
    """The characters from start up to end, taken from the pieces that hold them."""
    first = F.floor(start / PIECE).cast("int")
    some = F.array_join(stretch(pieces, first, F.greatest(F.floor(end / PIECE).cast("int"), first)), "")
    return F.substr(some, start - first * PIECE + 1, end - start)


def hinted(pattern: str) -> Column:
    return F.contains(F.col("text"), F.lit(pattern)) if pattern.isalnum() or pattern == "@" else F.col("text").rlike(pattern)


def no_spans() -> Column:
    return F.array().cast("array<struct<start:int,end:int,found:string>>")


def luhn(digits: Column) -> Column:
    """Does a string of digits pass the check sum?"""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") * 2 / 10).cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def passes(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(found, r"\."), lambda p: p.cast("double") <= 255)
    if kind == "card":
        return F.length(digits).between(14, 19) & F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def base_spans(df: DataFrame) -> DataFrame:
    """Adds base: array of (start, rank, end), by start and then kind. df has text."""
    for kind in KINDS:
        df = df.withColumn(f"found_{kind}", F.when(hinted(BASE_NEEDS[kind]), located(F.col("text"), BASE[kind])).otherwise(no_spans()))

    def part(i, kind):
        good = F.filter(F.col(f"found_{kind}"), lambda x: passes(kind, x["found"]))
        return F.transform(good, lambda x: F.struct(x["start"].alias("start"), F.lit(i).alias("rank"), x["end"].alias("end")))

    parts = [part(i, kind) for i, kind in enumerate(KINDS)]
    return df.withColumn("base", F.array_sort(F.concat(*parts))).drop(*[f"found_{k}" for k in KINDS])


def candidates(df: DataFrame) -> DataFrame:
    """Adds cand: array of (start, end, rank, found, before, after) of the generators' proposals."""
    for kind in KINDS:
        df = df.withColumn(f"cand_{kind}", F.when(hinted(NEEDS[kind]), located(F.col("text"), GENERATORS[kind])).otherwise(no_spans()))

    def part(i, kind):
        return F.transform(F.col(f"cand_{kind}"), lambda x: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), F.lit(i).alias("rank"), x["found"].alias("found"),
            between(F.col("pieces"), F.greatest(x["start"] - AROUND, F.lit(0)), x["start"]).alias("before"),
            between(F.col("pieces"), x["end"], x["end"] + 2).alias("after")))

    some = sum((F.size(f"cand_{k}") for k in KINDS), F.lit(0)) > 0
    df = df.withColumn("pieces", F.when(some, in_pieces(F.col("text"))).otherwise(F.array().cast("array<string>")))
    parts = [part(i, kind) for i, kind in enumerate(KINDS)]
    return df.withColumn("cand", F.concat(*parts)).drop("pieces", *[f"cand_{k}" for k in KINDS])



def marked(df: DataFrame) -> DataFrame:
    """Replaces base and cand by `marks`: base spans (tag 0) and candidates (tag 1) along the text, base spans first where they start together; base stays."""
    def mark(x, tag, *texts):
        return F.struct(x["start"].alias("start"), F.lit(tag).alias("tag"), x["rank"].alias("rank"), x["end"].alias("end"),
                        *[t.alias(n) for t, n in zip(texts, ("found", "before", "after"))])

    none = F.lit(None).cast("string")
    spans = F.transform("base", lambda b: mark(b, 0, none, none, none))
    return df.withColumn("marks", F.sort_array(F.concat(spans, F.transform("cand", lambda c: mark(c, 1, c["found"], c["before"], c["after"]))))).drop("cand")


def reached(marks: Column, some=lambda m: F.lit(True)) -> Column:
    """For each mark the farthest end of the base spans up to it, of those that `some` holds of; -1 for none."""
    return scanned(F.transform(marks, lambda m: F.when((m["tag"] == 0) & some(m), m["end"]).otherwise(-1)), F.greatest)


def ahead(marks: Column, some) -> Column:
    """For each mark the start of the next base span that `some` holds of; the greatest number for none."""
    starts = F.transform(F.reverse(marks), lambda m: F.when((m["tag"] == 0) & some(m), m["start"]).otherwise((1 << 31) - 1))
    return F.reverse(scanned(starts, F.least))


def plain_mail(found: Column) -> Column:
    """A written-out address with its signs."""
    at = F.regexp_replace(found, r"(?i)\x20?[\[({](?:at|@)[\])}]\x20?|\x20at\x20", "@")
    return F.regexp_replace(at, r"(?i)\x20?[\[({](?:dot|\.)[\])}]\x20?|\x20dot\x20", ".")


def features(c: Column) -> list[Column]:
    """What a candidate says and what stands around it, in the order of FEATURES. Which signs it is written with does not count."""
    found, before = c["found"], c["before"]
    yes = lambda cond: F.coalesce(cond, F.lit(False)).cast("double")
    digits = F.regexp_replace(found, "[^0-9]", "")
    groups = F.filter(F.split(found, "[^0-9]+"), lambda g: g != "")
    mail = plain_mail(found)
    host, local = F.substring_index(mail, "@", -1), F.substring_index(mail, "@", 1)
    octets = found.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$") & passes("ip", found)
    hextets = found.rlike(r"^(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$") | (found.rlike("::[0-9A-Fa-f]") & ~found.rlike("::.*::|:::"))
    month, day = "(?:0?[1-9]|1[0-2])", "(?:0?[1-9]|[12][0-9]|3[01])"
    dated = found.rlike(rf"^(?:(?:19|20)[0-9][0-9][./_-]?{month}[./_-]?{day}(?![0-9])|(?:19|20)[0-9][0-9](?:0[1-9]|1[0-2])(?:0[1-9]|[12][0-9]|3[01])|{day}[./-]{day}[./-](?:19|20)[0-9][0-9])")
    out = [F.length(digits), F.size(groups), F.array_max(F.transform(groups, lambda g: F.length(g))), F.length(F.try_element_at(groups, F.lit(1))),
           F.length(F.try_element_at(groups, F.lit(-1))), F.coalesce(F.substring(digits, 1, 1).try_cast("int"), F.lit(-1)),
           yes(passes("card", found)), yes(octets), yes(hextets), yes(dated), yes(digits.rlike("^97[89]")), F.size(F.split(host, r"\.")),
           F.length(F.regexp_extract(host, r"\.([A-Za-z]+)$", 1)), yes(local.rlike(PROSE)), yes(host.rlike(FILES)),
           yes(before.rlike(r"[A-Za-z0-9_=\"'/.-]$")), yes(c["after"].rlike(r"^[A-Za-z0-9_@/]"))]
    out += [yes(before.rlike(HINTS[h])) for h in HINTS] + [yes((F.length(before) == 0) | before.rlike("\n$"))]
    return [F.coalesce(x.cast("double"), F.lit(0.0)) for x in out]


#: Words that stand before "at" and a host name in prose; last labels of file names.
PROSE = r"(?i)^(?:[a-z]{1,12}ing|look|looks|looked|meet|us|me|is|are|was|were|be|it|him|them|find|found|available|online|page|site|here|hosted|live|more|details|read|start|see|stay|arrive|work|works)$"
FILES = r"(?i)\.(?:png|jpe?g|gif|svg|webp|js|css|html?|php|pdf|zip|gz|exe|txt)$"


def reshaped(kind: str, found: Column) -> tuple[list[Column], list[Column]]:
    """A base span in other shapes that its generator matches, and counterexamples made of it."""
    digits = F.regexp_replace(found, "[^0-9]", "")
    cut = lambda s, i, n: F.substr(s, F.lit(i), F.lit(n))
    if kind == "email":
        local, host = F.substring_index(found, "@", 1), F.substring_index(found, "@", -1)
        named = lambda at, dot: F.concat(local, F.lit(at), F.replace(host, F.lit("."), F.lit(dot)))
        good = [named(" [at] ", " [dot] "), named(" at ", " dot "), named("(at)", "(dot)"), named("[at]", "."), named(" at ", "."), named(" {at} ", " dot ")]
        bad = [F.concat(F.lit(w), F.lit(" at "), host) for w in ("look", "us", "hosting", "more", "found")]
        return good, bad + [F.concat(local, F.lit(x)) for x in ("@4.17.21", "@2x.png", " at index.html", "[at]1.0.3")]
    if kind == "ip":
        parts = F.split(found, r"\.")
        octet = lambda i: F.coalesce(F.try_element_at(parts, F.lit(i)).try_cast("int"), F.lit(0))
        hexes = [F.lower(F.hex(octet(i) * 251 + 7 * i)) for i in (1, 2, 3, 4)]
        good = [F.concat_ws(":", F.lit("2001"), F.lit("db8"), *hexes, F.lit("0"), F.lit("1")), F.concat(F.lit("fe80::"), F.concat_ws(":", *hexes)), F.concat_ws(":", *hexes, *hexes)]
        bad = [F.concat_ws(".", octet(1), octet(2) + 300, octet(3), octet(4)), F.concat_ws(".", octet(1), octet(2), octet(3)), F.concat_ws(".", *[octet(i) for i in (1, 2, 3, 4, 1)]),
               F.concat_ws(".", octet(1) % 28 + 1, octet(2) % 12 + 1, F.lit(2024)), F.concat_ws(":", *[octet(i) % 50 + 10 for i in (1, 2, 3, 4)]), F.concat_ws(":", *[F.lpad(F.lower(F.hex(octet(i))), 2, "0") for i in (1, 2, 3, 4, 1, 2)])]
        return good, bad
    if kind == "card":
        wrong = F.concat(F.substr(digits, F.lit(1), F.length(digits) - 1), F.pmod(F.substr(digits, F.length(digits)).cast("int") + 1 + F.pmod(F.xxhash64(digits), F.lit(8)), F.lit(10)).cast("string"))
        shapes = lambda d: [F.regexp_replace(d, "([0-9]{4})(?=[0-9])", "$1" + sep) for sep in (".", "/", "_", " - ", "--", "")]
        return shapes(digits), [*shapes(wrong), F.concat(F.lit("20240115"), F.substr(digits, F.lit(7), F.lit(8))), F.concat(F.lit("2023-11-05 "), cut(digits, 1, 8))]
    tail = F.substr(digits, F.length(digits) - 9)
    code = F.substr(digits, F.lit(1), F.length(digits) - 10)
    a, b, c = cut(tail, 1, 3), cut(tail, 4, 3), cut(tail, 7, 4)
    country = F.when(code == "", F.lit("1")).otherwise(code)
    good = [F.concat(F.lit("("), a, F.lit(") "), b, F.lit("-"), c), *[F.concat_ws(sep, a, b, c) for sep in "-. /"], F.concat_ws(" ", country, a, b, c),
            F.concat(F.lit("00"), F.concat_ws(" ", country, a, b, c)), F.concat(country, F.lit(" ("), a, F.lit(") "), b, F.lit("-"), c)]
    date = F.concat(F.lit("20"), F.lpad(cut(tail, 1, 2), 2, "0"), F.lit("-"), F.lpad((cut(tail, 3, 2).cast("int") % 12 + 1).cast("string"), 2, "0"), F.lit("-"), F.lpad((cut(tail, 5, 2).cast("int") % 28 + 1).cast("string"), 2, "0"))
    bad = [date, F.concat(date, F.lit(" "), c), F.concat_ws(".", (cut(tail, 1, 2).cast("int") % 28 + 1), (cut(tail, 3, 2).cast("int") % 12 + 1), F.lit(2024)), tail, cut(tail, 1, 7), F.concat(tail, c, b),
           F.concat_ws("-", F.lit("978"), F.lit("3"), b, cut(tail, 1, 5), F.lit("7")), F.concat_ws(".", cut(a, 1, 2), cut(b, 1, 2), cut(c, 1, 2), cut(c, 3, 2)), F.concat_ws(".", cut(a, 1, 1), F.concat(b, c)), F.concat_ws("-", tail, cut(c, 1, 2))]
    return good, bad


def made_up(spark) -> DataFrame:
    """Spans to learn from where a table holds few: rank, found, before, after, draw."""
    n, h = F.col("id"), lambda i, m: F.pmod(F.xxhash64(F.lit(i), F.col("id")), F.lit(m))
    number = lambda i, size: F.lpad(h(i, 10**size).cast("string"), size, "0")
    stem = F.concat(F.lit("4"), number(1, 14))
    last = F.array([F.lit(str(i)) for i in range(10)])
    card = F.concat(stem, F.element_at(F.filter(last, lambda d: luhn(F.concat(stem, d))), 1))
    names, hosts = (F.array([F.lit(x) for x in xs]) for xs in (["anna", "j.doe", "k_lee", "info", "maria.s", "bob"], ["example.org", "mail.example.com", "web.de", "uni.edu", "corp.co.uk"]))
    mail = F.concat(F.element_at(names, (h(2, 6) + 1).cast("int")), F.when(h(3, 2) == 0, h(4, 99).cast("string")).otherwise(F.lit("")), F.lit("@"), F.element_at(hosts, (h(5, 5) + 1).cast("int")))
    found = [mail, F.concat_ws(".", *[h(i, 256) for i in (6, 7, 8, 9)]), card, F.concat(F.lit("+"), (h(10, 98) + 1).cast("string"), F.lit(" "), (h(11, 8) + 2).cast("string"), number(12, 9))]
    before = F.element_at(F.array([F.lit(x) for x in ("", "and so on with ", "please use ", "this (", "words\n", "more text, ")]), (h(13, 6) + 1).cast("int"))
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("rank"), x.alias("found")) for i, x in enumerate(found)]))
    return spark.range(300).select(each.alias("x"), before.alias("before"), F.lit(" a").alias("after"), F.xxhash64(F.lit(21), n).alias("draw")).select("x.rank", "x.found", "before", "after", "draw")


@dataclass(frozen=True)
class Model:
    """Margins of the trees by kind; the least margin that is taken as personal data, None for never."""

    trees: dict[int, tuple]
    least: dict[int, float | None]

    def accepted(self) -> Column:
        """The candidates of `cand` that are taken, by their features `f`."""
        cases = [f"WHEN {rank} THEN {margin_sql(*self.trees[rank], 'c.f')} >= {least!r}D" for rank, least in self.least.items() if least is not None]
        return F.expr(f"filter(cand, c -> CASE c.rank {' '.join(cases)} ELSE false END)" if cases else "filter(cand, c -> false)")


def judged(df: DataFrame) -> DataFrame:
    """Adds cand: the candidates with y, 1 for a base span of the kind, 0 for what fails its kind's check or overlaps another kind's base span, else null."""
    other = lambda m: m["rank"] != 3
    df = marked(df)

    def label(m, i, reach, next_start):
        # At most one base span and one candidate of each kind start at a place, so an equal span is among the last eight marks.
        near = stretch(F.col("marks"), F.greatest(i - 7, F.lit(0)), i)
        base = F.exists(near, lambda b: (b["tag"] == 0) & (b["rank"] == m["rank"]) & (b["start"] == m["start"]) & (b["end"] == m["end"]))
        digits = F.length(F.regexp_replace(m["found"], "[^0-9]", ""))
        crossed = (F.get(reach, i) > m["start"]) | (F.get(next_start, i) < m["end"])
        dotted = m["found"].rlike(r"^[0-9.]+$")
        wrong = F.when(m["rank"] == 0, False).when(m["rank"] == 1, dotted & ~(F.coalesce(passes("ip", m["found"]), F.lit(False)) & (F.size(F.split(m["found"], r"\.")) == 4))).when(
            m["rank"] == 2, ~passes("card", m["found"])).otherwise(~digits.between(7, 15) | crossed)
        return F.struct(*[m[n].alias(n) for n in ("tag", "rank", "start", "found", "before", "after")], F.when(base, 1.0).when(wrong, 0.0).alias("y"))

    found = let(reached(F.col("marks"), other), lambda a: let(ahead(F.col("marks"), other), lambda b: F.transform("marks", lambda m, i: F.when(m["tag"] == 1, label(m, i, a, b)))))
    return df.withColumn("cand", F.filter(found, lambda m: m.isNotNull())).drop("marks")


def examples(rows: DataFrame, rank: int) -> DataFrame:
    """What a generator's trees learn from: f, y, held_out and n, the number of candidates and rewritten spans that are alike in these. `rows` are judged candidates."""
    own = rows.where((F.col("rank") == rank) & F.col("y").isNotNull()).select("found", "before", "after", "draw", "y")
    spans = own.where("y = 1").drop("y").unionByName(made_up(rows.sparkSession).where(F.col("rank") == rank).drop("rank"))
    good, bad = reshaped(KINDS[rank], F.col("found"))
    other = F.explode(F.array(*[F.struct(x.alias("found"), F.lit(y).alias("y")) for xs, y in ((good, 1.0), (bad, 0.0)) for x in xs]))
    made = spans.select(other.alias("x"), "before", "after", "draw").select("x.found", "before", "after", "draw", "x.y")
    c = {k: F.col(k) for k in ("found", "before", "after")}
    # A span's shapes are all on one side.
    some = own.unionByName(made).select(F.array(*features(c)).alias("f"), "y", (F.pmod("draw", F.lit(4)) == 0).alias("held_out"))
    return some.groupBy("f", "y", "held_out").agg(F.count(F.lit(1)).cast("double").alias("n"))


def fit(df: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> Model:
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # The outer form: for the plain one a filter on the whole candidate search would be made and worked out once more.
    rows = judged(candidates(base_spans(docs))).select("id", F.inline_outer("cand")).where(F.col("rank").isNotNull()).drop("tag")
    rows = scratch.save(rows.withColumn("draw", F.xxhash64("id", "start", "rank")))
    there = {r["rank"] for r in rows.select("rank").distinct().collect()}
    trees, least = {}, {}
    for rank in sorted(there):
        some = scratch.save(examples(rows, rank))
        n = some.count()
        # In an order of its own, as sums of the training depend on it.
        dealt = some.repartition(-(-n // TASK_ROWS)).sortWithinPartitions("f", "y", "held_out")
        dealt = dealt.select("y", "held_out", "n", *[F.col("f")[i].alias(name) for i, name in enumerate(FEATURES)])
        dealt = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(dealt).select("y", "held_out", "n", "x").cache()
        train, test = dealt.where("NOT held_out"), dealt.where("held_out")
        # Spark looks for splits among the square of this number of rows, 10,000 at least.
        bins = max(32, isqrt(n) + 1)
        model = GBTClassifier(featuresCol="x", labelCol="y", weightCol="n", maxIter=ROUNDS, maxDepth=DEPTH, maxBins=bins, stepSize=0.3, seed=7).fit(train)
        trees[rank] = (model.trees, model.treeWeights)
        least[rank] = _least(model.transform(test).select("y", "n", (2 * vector_to_array("probability")[1] - 1).alias("p")))
        dealt.unpersist()
    return Model(trees, least)


def _least(tested: DataFrame) -> float | None:
    """The least margin whose calibrated probability reaches PRECISION on candidates left out of the training; rows count n times."""
    if tested.isEmpty():
        return None
    # Spark's probability is the logistic function of twice the margin.
    margins = tested.select("y", "n", F.atanh(F.least(F.greatest("p", F.lit(-1 + 1e-12)), F.lit(1 - 1e-12))).alias("z"))
    margins = margins.groupBy("y", "z").agg(F.sum("n").alias("n"))
    curve = IsotonicRegression(featuresCol="z", labelCol="y", weightCol="n").fit(margins)
    found = [float(b) for b, p in zip(curve.boundaries.toArray(), curve.predictions.toArray()) if p >= PRECISION]
    return min(found) if found else None


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(name, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Adds base and spans (array of (start, rank, end)) and text with nulls as empty. Added spans that a base span holds are left out."""
    rows = candidates(base_spans(df.withColumn("text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))))
    if not model.trees:
        return rows.withColumn("spans", F.col("base")).drop("cand")
    # Features once a candidate, not once a node of a tree, and only of candidates that no base span holds.
    rows = marked(rows)
    free = F.filter(F.zip_with("marks", reached(F.col("marks")), lambda m, end: F.struct(m.alias("m"), end.alias("reach"))), lambda x: (x["m"]["tag"] == 1) & (x["reach"] < x["m"]["end"]))
    rows = rows.withColumn("cand", F.transform(F.transform(free, lambda x: x["m"]), lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["rank"].alias("rank"), F.array(*features(c)).alias("f")))).drop("marks")
    added = F.transform(model.accepted(), lambda c: F.struct(c["start"].alias("start"), c["rank"].alias("rank"), c["end"].alias("end")))
    return rows.withColumn("spans", F.array_sort(F.array_distinct(F.concat("base", added)))).drop("cand")


def redact(text: Column, spans: Column) -> Column:
    """The text with each stretch of overlapping spans replaced by the first one's kind in brackets."""
    name = F.array(*[F.lit(k.upper()) for k in KINDS])

    def written(pieces, ends):
        def piece(s, i):
            before = F.coalesce(F.get(ends, i - 1), F.lit(0))
            return F.when(s["start"] >= before, F.concat(between(pieces, before, s["start"]), F.lit("["), F.element_at(name, s["rank"] + 1), F.lit("]"))).otherwise("")

        tail = between(pieces, F.coalesce(F.try_element_at(ends, F.lit(-1)), F.lit(0)), F.length(text))
        return F.concat(F.array_join(F.transform(spans, piece), ""), tail)

    return let(in_pieces(text), lambda p: let(scanned(F.transform(spans, lambda s: s["end"]), F.greatest), lambda e: written(p, e)))
