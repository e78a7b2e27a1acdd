"""Language identification, word first: known words by log frequency, unseen ones by shorter and shorter n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.llm import ship
from rosterflow.llm.batches import byte_slices, in_turn

WORDS = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"


@dataclass(frozen=True)
class FitLimits:
    """Bounds of the training sample and of the model; they don't depend on the size of the corpus.

    ``docs_per_language`` rows of each language are learned from, those with the
    smallest hash of their key, of the ``languages`` with the most rows.  ``words`` and
    ``grams`` bound the entries of the whole model, shared out evenly among languages
    (and, for n-grams, lengths); the most frequent ones are taken.
    """

    docs_per_language: int = 2000
    languages: int = 256
    words: int = 200_000
    grams: int = 100_000
    longest_gram: int = 5


@dataclass
class LanguageModel:
    """Log frequencies by language.  ``words`` and ``grams[n]`` map an entry to a row of ``table``."""

    languages: list[str]
    prior: np.ndarray
    table: np.ndarray
    words: dict[str, int]
    grams: list[dict[str, int]]
    floor: np.ndarray
    #: log-probability added when a word is scored by n-grams of this length
    penalty: list[float] = field(default_factory=list)

    def score_word(self, word: str) -> np.ndarray:
        """The word's log frequency by language, by the longest n-grams that the model knows."""
        row = self.words.get(word)
        if row is not None:
            return self.table[row]
        framed = f"^{word}$"
        for n in range(len(self.grams) - 1, 0, -1):
            known = self.grams[n]
            rows = [known[g] for g in (framed[i : i + n] for i in range(len(framed) - n + 1)) if g in known]
            if rows:
                return self.table[rows].mean(axis=0) + self.penalty[n]
        return self.floor


def count_words(df: DataFrame, text: str) -> DataFrame:
    """``lang, word, n`` of rows with ``lang`` and a text, for words of letters in lower case."""
    words = F.explode(F.expr(f"regexp_extract_all(lower({text}), '\\\\p{{L}}+', 0)"))
    return df.select("lang", words.alias("word")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))


def fit(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", limits: FitLimits = FitLimits()) -> LanguageModel | None:
    """Learn from the rows with a text and a language; None if there are none.

    What comes to the driver is the model alone, which ``limits`` bounds.
    """
    rows = df.select(F.xxhash64(key).alias("h"), F.col(text).alias("body"), F.col(lang).alias("lang")).where(
        "body IS NOT NULL AND lang IS NOT NULL"
    )
    totals = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(limits.languages).collect()
    if not totals:
        return None
    languages = sorted(r["lang"] for r in totals)
    count = {r["lang"]: r["count"] for r in totals}
    # in two steps, so that no task takes all hashes of a frequent language
    least = lambda frame, *keys: frame.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy("h"))).where(
        F.col("nth") <= limits.docs_per_language
    )
    dealt = rows.select("lang", "h", F.pmod("h", F.lit(SPREAD)).alias("part")).where(F.col("lang").isin(languages))
    cutoffs = (
        least(least(dealt, "lang", "part"), "lang")
        .groupBy("lang").agg(F.max("h").alias("cutoff")).collect()
    )
    # one row a language, at most `limits.languages`
    bound = df.sparkSession.createDataFrame([(r["lang"], r["cutoff"]) for r in cutoffs], "lang string, cutoff bigint")
    sample = rows.join(F.broadcast(bound), "lang").where("h <= cutoff")
    words = count_words(sample, "body").cache()
    share = max(1, limits.words // len(languages))
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = words.withColumn("nth", F.row_number().over(by_count)).where(F.col("nth") <= share).select("lang", "word", "n")
    framed = words.select("lang", F.concat(F.lit("^"), "word", F.lit("$")).alias("w"), "n")
    size = F.explode(F.sequence(F.lit(1), F.lit(limits.longest_gram))).alias("size")
    at = F.explode(F.sequence(F.lit(1), F.col("room")))
    grams = (
        framed.select("*", size).withColumn("room", F.length("w") - F.col("size") + 1).where("room >= 1")
        .withColumn("at", at).select("lang", "size", F.expr("substring(w, at, size)").alias("word"), "n")
        .groupBy("lang", "size", "word").agg(F.sum("n").alias("n"))
    )
    gram_share = max(1, limits.grams // (len(languages) * limits.longest_gram))
    by_size = Window.partitionBy("lang", "size").orderBy(F.desc("n"), "word")
    top_grams = grams.withColumn("nth", F.row_number().over(by_size)).where(F.col("nth") <= gram_share)
    listed = top.withColumn("size", F.lit(0)).unionByName(top_grams.select("lang", "word", "n", "size")).collect()
    words.unpersist()
    return build_model(languages, [count[x] for x in languages], [tuple(r) for r in listed], limits.longest_gram)


def build_model(languages: list[str], docs: list[int], entries: list[tuple[str, str, int, int]], longest: int) -> LanguageModel:
    """The model of entries ``(lang, entry, n, size)``, where size 0 is a word."""
    number = {x: i for i, x in enumerate(languages)}
    names: list[dict[str, int]] = [{} for _ in range(longest + 1)]
    for _, entry, _, size in entries:
        names[size].setdefault(entry, len(names[size]))
    tables, start = [], 0
    for size, known in enumerate(names):
        counts = np.zeros((len(known), len(languages)))
        for lang, entry, n, of in entries:
            if of == size:
                counts[known[entry], number[lang]] += n
        smooth = 0.5
        tables.append(np.log((counts + smooth) / (counts.sum(axis=0) + smooth * (len(known) + 1))))
        names[size] = {entry: row + start for entry, row in known.items()}
        start += len(known)
    prior = np.log(np.array(docs, dtype=float) / sum(docs))
    floor = np.zeros(len(languages))
    return LanguageModel(languages, prior, np.concatenate(tables), names[0], names, floor, [0.0] * (longest + 1))


def softmax_best(total: np.ndarray) -> tuple[int, float]:
    best = int(total.argmax())
    return best, float(1.0 / np.exp(total - total[best]).sum())


#: Parts that the hashes of a language are dealt to before the smallest are taken.
SPREAD = 64
CACHED_WORDS, CACHED_CHARS = 200_000, 20_000_000


class WordScores(dict):
    """Rows of ``table`` by word; words are scored when they are first seen, and all forgotten when too many."""

    def __init__(self, model: LanguageModel):
        super().__init__()
        self.model = model
        self.table = np.zeros((CACHED_WORDS + 1, len(model.languages)))
        self.chars = 0

    def __missing__(self, word: str) -> int:
        row = len(self)
        self.chars += len(word)
        self.table[row] = self.model.score_word(word)
        self[word] = row
        return row

    def total(self, words: list[str]) -> np.ndarray:
        total = np.zeros(len(self.model.languages))
        for i in range(0, len(words), CACHED_WORDS // 2):
            part = words[i : i + CACHED_WORDS // 2]
            if len(self) > CACHED_WORDS // 2 or self.chars > CACHED_CHARS:
                self.clear()
                self.chars = 0
            total += self.table[[self[w] for w in part]].sum(axis=0)
        return total


def predict(value: str | None, scores: WordScores) -> tuple[str, float]:
    """The language and its posterior probability; the first language by name wins ties."""
    words = WORDS.findall(value.lower()) if value else []
    if not any(c.isalpha() for w in words for c in w):
        return UNDETERMINED, 0.0
    model = scores.model
    best, score = softmax_best(model.prior + scores.total(words))
    return model.languages[best], score


def identify(df: DataFrame, model: LanguageModel | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``lang_pred``, ``score`` of every row, by its whole text.

    ``und`` with score 0 if the text is null or empty or has no letter, or if there was
    nothing to learn from.  Rows are handled one by one: repeated rows get equal
    results, an empty frame none.  The prediction sees the text alone.
    """
    spark = df.sparkSession
    ship(spark)
    picked = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = picked.schema["key"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(model)  # bounded by FitLimits

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = WordScores(shared.value) if shared.value is not None else None
        for part in byte_slices(batches, "text"):
            values = part.column("text").to_pylist()
            found = [predict(v, scores) if scores is not None else (UNDETERMINED, 0.0) for v in values]
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                ["key", "lang_pred", "score"],
            )

    return picked.mapInArrow(in_turn("language", score), f"key {kind}, lang_pred string, score double")
