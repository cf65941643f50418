"""Text operators. Tokens stay in the row's own array until a corpus-wide count needs them exploded."""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import CountVectorizer, HashingTF, IDF, StopWordsRemover, Tokenizer, Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.cols import as_list, r, same_keys, with_row
from ..functions.ordered import number_rows
from ..functions.store import saved
from .window import top_k_per_group


BROADCAST_WORDS = 100_000  # a vocabulary of this size is a few megabytes


def words(text: str, pattern: str = r"\s+") -> Column:
    """Lower-cased tokens of the whole text, empty ones left out."""
    return F.filter(F.split(F.lower(text), pattern), lambda w: w != "")


def tokenize(df: DataFrame, text: str = "text", out: str = "tokens", pattern: str = r"\s+") -> DataFrame:
    return df.withColumn(out, words(text, pattern))


def word_count(df: DataFrame, text: str = "text", out: str = "word_count") -> DataFrame:
    return df.withColumn(out, F.size(words(text)))


def mean_word_length(df: DataFrame, text: str = "text", out: str = "mean_word_length") -> DataFrame:
    """Mean length of the words, two digits; 0 for an empty text."""
    total = F.aggregate(words(text), F.lit(0), lambda a, w: a + F.length(w))
    return df.withColumn(out, F.round(F.coalesce(F.try_divide(total.cast("double"), F.size(words(text))), F.lit(0.0)), 2))


def sentences(df: DataFrame, key: str, text: str = "text", pattern: str = r"[.!?]+\s*") -> DataFrame:
    """(key, sentence number, sentence, words) from a text split at sentence ends."""
    parts = F.filter(F.split(F.col(text), pattern), lambda s: s != "")
    rows = df.select(key, F.posexplode(parts).alias("sentence_no", "sentence"))
    return rows.withColumn("n_words", F.size(words("sentence")))


def remove_stopwords(df: DataFrame, tokens: str, stop, out: str | None = None) -> DataFrame:
    stop = list(stop)
    return df.withColumn(out or tokens, F.filter(tokens, lambda w: ~w.isin(stop)))


def hashing_tf(df: DataFrame, n: int, tokens: str = "tokens", out: str = "tf") -> DataFrame:
    return HashingTF(inputCol=tokens, outputCol=out, numFeatures=n).transform(df)


def _row_counts(tokens: str) -> Column:
    """(term, tf) of one row's tokens, from the ends of the runs in their order. The arrays are bound by lambdas, as a column used twice is worked out twice."""

    def runs(held: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(held) - 1), lambda i: (i == 0) | ~F.get(held, i).eqNullSafe(F.get(held, i - 1)))

        def ends(at: Column) -> Column:
            return F.transform(at, lambda i, j: F.struct(F.get(held, i).alias("term"), (F.coalesce(F.get(at, j + 1), F.size(held)) - i).cast("long").alias("tf")))

        return F.get(F.transform(F.array(starts), ends), F.lit(0))

    return F.get(F.transform(F.array(F.sort_array(tokens)), runs), F.lit(0))


def term_counts(df: DataFrame, key: str, tokens: str = "tokens", keep=()) -> DataFrame:
    """(key, term, tf), counted inside the row; rows that share a key are counted together, by a shuffle that is left out if no key repeats."""
    keys = [key, *as_list(keep)]
    counts = df.where(F.size(tokens) > 0).select(*keys, F.inline(_row_counts(tokens)))
    if df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return counts
    return counts.groupBy(*keys, "term").agg(F.sum("tf").alias("tf"))


def of_terms(counts: DataFrame, table: DataFrame, weight: str, most: int = BROADCAST_WORDS) -> DataFrame:
    """Join counts to a table by term. The `most` terms of the largest weight are looked up in place; only rarer ones are shuffled.

    Both frames are read more than once, so they should be saved ones.
    """
    terms = table.groupBy("term").agg(F.max(weight).alias("__w")).orderBy(F.desc("__w"), "term").limit(most).select("term")
    hot = table.join(F.broadcast(terms), "term", "left_semi")  # a term that comes twice is hot with all its rows or not at all
    if table.count() <= most:
        return counts.join(F.broadcast(table), "term")
    met = counts.join(F.broadcast(hot.withColumn("__hot", F.lit(True))), "term", "left")
    rare = met.where("__hot IS NULL").select(*counts.columns).join(table, "term")
    return met.where("__hot").drop("__hot").unionByName(rare)


def count_vectorize(df: DataFrame, key: str, tokens: str = "tokens", min_df: int = 1, max_df: float = 1.0,
                    max_features: int | None = None) -> DataFrame:
    """Bag of words in long form over the learned vocabulary (largest corpus counts first, ties by term)."""
    tf = saved(term_counts(df, key, tokens), "counts")
    vocab = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    vocab = with_row(vocab, df.agg(F.count(F.lit(1)).alias("__n")))
    vocab = vocab.where((F.col("df") >= min_df) & (F.col("df") <= F.col("__n") * max_df))
    if max_features:
        vocab = vocab.orderBy(F.desc("total"), "term").limit(max_features)
    return of_terms(tf, saved(vocab.select("term", "df"), "vocabulary"), "df").select(key, "term", "tf", "df")


def count_vectors(df: DataFrame, vocab_size: int, min_df: float = 1.0, tokens: str = "tokens", out: str = "counts") -> DataFrame:
    return CountVectorizer(inputCol=tokens, outputCol=out, vocabSize=vocab_size, minDF=min_df).fit(df).transform(df)


def tf_idf(df: DataFrame, key: str, tokens: str = "tokens", sublinear: bool = True, smooth: bool = True, min_df: int = 1,
           max_df: float = 1.0, max_features: int | None = None, l2: bool = True) -> DataFrame:
    """(key, term, weight): (1 + ln tf) * (ln((1 + n) / (1 + df)) + 1), rows scaled to unit length."""
    counts = with_row(count_vectorize(df, key, tokens, min_df, max_df, max_features), df.agg(F.count(F.lit(1)).alias("__n")))
    tf = 1 + F.ln("tf") if sublinear else F.col("tf").cast("double")
    one = 1 if smooth else 0
    idf = F.ln((F.col("__n") + one) / (F.col("df") + one)) + 1
    weights = counts.select(key, "term", (tf * idf).alias("weight"))
    if not l2:
        return weights
    # A window over one document's terms: the weights are worked out once, not once more for a table of norms.
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(key)))
    return weights.select(key, "term", (F.col("weight") / norm).alias("weight"))


@cache
def _accent_table() -> tuple[str, str]:
    """Letters that decompose to one letter and marks, with that letter; then the marks, which translate to nothing."""
    letters, marks = [], []
    for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x20000)]):
        parts = unicodedata.normalize("NFD", c)
        base = [x for x in parts if not unicodedata.combining(x)]
        if not base:
            marks.append(c)
        elif len(base) == 1 and parts != c and base[0] != c:
            letters.append((c, base[0]))
    return "".join(c for c, _ in letters) + "".join(marks), "".join(b for _, b in letters)


def strip_accents(df: DataFrame, text: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or text, F.translate(F.col(text), *_accent_table()))


def top_terms_doc(weights: DataFrame, key: str, n: int) -> DataFrame:
    return top_k_per_group(weights, key, ["-weight", "term"], n, "rank")


def top_terms_by_class(weights: DataFrame, classes: DataFrame, key: str, label: str, min_tfidf: float = 0.1, n: int = 10,
                       digits: int = 9) -> DataFrame:
    """Mean weight over all documents of the class (small weights count as zero), n best terms per class."""
    sizes = classes.groupBy(label).agg(F.count(F.lit(1)).alias("__docs"))
    strong = weights.where(F.col("weight") >= min_tfidf).join(classes.select(key, label), key)
    sums = strong.groupBy(label, "term").agg(F.sum("weight").alias("__w"))
    means = same_keys(sums, sizes, label).select(label, "term", r(F.col("__w") / F.col("__docs"), digits).alias("mean_weight"))
    return top_k_per_group(means, label, ["-mean_weight", "term"], n, "rank")


def svd(df: DataFrame, vec: str, k: int, key: str, out: str = "factors") -> tuple[DataFrame, list[float]]:
    """Truncated SVD of a (bounded width) term matrix: factors per row and the k singular values."""
    result = RowMatrix(MLUtils.convertVectorColumnsFromML(df.select(vec), vec)).computeSVD(k)
    v = np.asarray(result.V.toArray())  # features x k, bounded by the hashed width
    arr = vector_to_array(vec)
    cols = [F.aggregate(F.zip_with(arr, F.array(*[F.lit(float(x)) for x in v[:, j]]), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
            for j in range(v.shape[1])]
    return df.select(key, F.array(*cols).alias(out)), [float(s) for s in result.s]


def word2vec(df: DataFrame, size: int, tokens: str = "tokens", min_count: int = 5, seed: int = 7, out: str = "embedding", partitions: int = 8):
    """Fitted model: `getVectors()` holds the words, `transform` the text means."""
    return Word2Vec(vectorSize=size, minCount=min_count, seed=seed, inputCol=tokens, outputCol=out, numPartitions=partitions).fit(df)


def mean_embedding(df: DataFrame, vectors: DataFrame, key: str, dims: int, tokens: str = "tokens", out: str = "embedding") -> DataFrame:
    """Average of the known word vectors of each text; zeros if none is known. `vectors` is (term, vector)."""
    counts = saved(term_counts(df, key, tokens), "counts")
    held = counts.groupBy("term").agg(F.count(F.lit(1)).alias("__df"))
    known = of_terms(counts, saved(vectors.join(held, "term"), "vectors"), "__df")
    sums = known.groupBy(key).agg(F.sum("tf").alias("__n"), *[F.sum(F.col("vector")[i] * F.col("tf")).alias(f"__{i}") for i in range(dims)])
    mean = F.when(F.col("__n").isNull(), F.array_repeat(F.lit(0.0), dims)).otherwise(F.array(*[F.col(f"__{i}") / F.col("__n") for i in range(dims)]))
    return df.select(key).join(sums, key, "left").select(key, mean.alias(out))


def vocabulary(df: DataFrame, tokens: str, num_words: int) -> DataFrame:
    """(term, rank) of the num_words most frequent words, ranks from 1; bounded by num_words."""
    counts = df.select(F.explode(tokens).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), "term").limit(num_words)
    return number_rows(top, ["-n", "term"], out="__pos").select("term", (F.col("__pos") + 1).cast("int").alias("rank"))


def ranks_of(ranks: dict[str, int]):
    """A column function from a token array to the ranks of its known words, in their order; the table is broadcast."""
    held = SparkSession.active().sparkContext.broadcast(ranks)

    @F.pandas_udf("array<int>")
    def look_up(tokens: pd.Series) -> pd.Series:
        rank = held.value.get
        return pd.Series([[i for i in map(rank, row) if i is not None] if row is not None else [] for row in tokens], dtype=object)

    return look_up


def texts_to_sequences(df: DataFrame, key: str, num_words: int, tokens: str = "tokens", fit_on: DataFrame | None = None, out: str = "sequence") -> DataFrame:
    """Words to frequency ranks, rarer words dropped; null tokens give an empty sequence.

    A vocabulary of at most BROADCAST_WORDS words is looked up inside the row, so no text is taken apart or shuffled. A larger one is
    joined, and only one text's own words are gathered at a time; keys must then be unique.
    """
    ranks = vocabulary(df if fit_on is None else fit_on, tokens, num_words)
    if num_words <= BROADCAST_WORDS:
        table = {term: rank for term, rank in ranks.select("term", "rank").collect()}  # at most num_words rows
        return df.select(key, ranks_of(table)(F.col(tokens)).alias(out))
    hits = df.select(key, F.posexplode(tokens).alias("pos", "term")).join(ranks, "term")
    seqs = hits.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "rank"))).alias("__s"))
    ordered = F.transform("__s", lambda s: s["rank"])
    return df.select(key).join(seqs, key, "left").select(key, F.coalesce(ordered, F.array().cast("array<int>")).alias(out))


def pad_sequences(df: DataFrame, seq: str, length: int, value=0) -> DataFrame:
    """Left pad, or keep the last `length` items."""
    n = F.size(seq)
    kept = F.slice(seq, F.greatest(n - length, F.lit(0)) + 1, length)
    return df.withColumn(seq, F.concat(F.array_repeat(F.lit(value), F.greatest(F.lit(length) - n, F.lit(0))), kept))


def text_featurizer(text: str = "text", n: int = 1 << 12, stop=None, out: str = "features") -> Pipeline:
    """Tokenize, drop stop words, hash, weight by IDF — one pipeline stage."""
    remover = StopWordsRemover(inputCol="__tokens", outputCol="__words", stopWords=list(stop)) if stop else StopWordsRemover(inputCol="__tokens", outputCol="__words")
    return Pipeline(stages=[Tokenizer(inputCol=text, outputCol="__tokens"), remover,
                            HashingTF(inputCol="__words", outputCol="__tf", numFeatures=n), IDF(inputCol="__tf", outputCol=out)])


def short_texts(df: DataFrame, n: int, text: str = "text") -> DataFrame:
    """Rows whose text has fewer than n words."""
    return word_count(df, text).where(F.col("word_count") < n)


def duplicate_texts(df: DataFrame, key: str, text: str = "text", label: str | None = None) -> DataFrame:
    """Texts held by several keys: size, smallest key, and whether the labels agree. The shuffle carries digests, not texts."""
    aggs = [F.count_distinct(F.col(key)).alias("n"), F.min(key).alias("first_key")]
    if label:
        aggs.append((F.count_distinct(F.col(label)) <= 1).alias("labels_agree"))
    return df.select(key, F.md5(text).alias("digest"), *as_list(label)).groupBy("digest").agg(*aggs).where("n > 1")


def annotate_tokens(df: DataFrame, tokens: str, tags: str, out: str = "annotated") -> DataFrame:
    """Tokens and their tags in one string; an `O` tag leaves the token bare."""
    pairs = F.zip_with(tokens, tags, lambda w, g: F.when((g == "O") | g.isNull(), w).otherwise(F.concat(w, F.lit("["), g, F.lit("]"))))
    return df.withColumn(out, F.array_join(pairs, " "))
