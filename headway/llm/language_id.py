"""Language identification by families: first the family, then the language within it.

A one-versus-rest linear support vector machine for each family picks the family. Within it, a
machine for each pair of its languages votes with its margin (one versus one), so closely related
languages are told apart by what differs between them alone. Features are byte trigrams, bigrams
and single bytes of the lower-cased whole text, hashed to DIMENSIONS buckets, as square roots of
their shares.

Machines are fitted on a bounded sample: at most ``max_rows`` labelled rows, an equal number for
each language, the rows with the smallest hashes of their keys. Each machine is fitted in a task
of its own; only weights reach the driver, (families + pairs) x DIMENSIONS numbers. Prediction
is a narrow stage over all rows.

Text that is null or has no letter is ``und`` with score 0. Without any labelled row all texts
are ``und``. With one language learned, every text with a letter is that language, score 1.
Result columns replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from headway.llm._common import importable

#: Families of language codes (ISO 639-1). A code that is not here is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt ug uz",
    "indo-aryan": "bn gu hi mr ne or pa si ur",
    "dravidian": "kn ml ta te",
    "semitic": "am ar he mt",
    "sinitic": "yue zh",
    "austronesian": "id jv mg ms tl",
}
DIMENSIONS = 1 << 12
#: Most labelled rows that are fitted on, over all languages.
MAX_ROWS = 2000
#: The sample of a language is drawn in as many equal parts, so that no task ranks a whole language.
PARTS = 16
EPOCHS, REGULARIZATION = 15, 1e-4
UNKNOWN = "und"


def family_of(lang: str) -> str:
    return next((family for family, codes in FAMILIES.items() if lang in codes.split()), lang)


def features(text: str) -> np.ndarray:
    """Square roots of the shares of the text's hashed byte n-grams; their squares add up to 1."""
    b = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    counts = np.bincount(b & 255, minlength=DIMENSIONS).astype(np.float64)
    for n, start in ((2, 0x9E3779B1), (3, 0x85EBCA6B)):
        if len(b) >= n:
            grams = np.full(len(b) - n + 1, start, np.uint32)
            for i in range(n):
                grams = (grams ^ b[i:len(b) - n + 1 + i]) * np.uint32(0x01000193)
            counts += np.bincount((grams ^ (grams >> np.uint32(15))) % DIMENSIONS, minlength=DIMENSIONS)
    return np.sqrt(counts / max(1.0, counts.sum())).astype(np.float32)


def fit_machine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and bias of a linear support vector machine for labels -1 and 1 (dual coordinate descent)."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    # The two sides weigh the same, however many rows each has.
    most = np.where(y > 0, 1 / max(1, (y > 0).sum()), 1 / max(1, (y < 0).sum())) / (2 * REGULARIZATION)
    weights, alpha, norms = np.zeros(x.shape[1]), np.zeros(len(y)), (x * x).sum(axis=1)
    random = np.random.RandomState(7)
    for _ in range(EPOCHS):
        for i in random.permutation(len(y)):
            step = np.clip(alpha[i] + (1 - y[i] * (x[i] @ weights)) / norms[i], 0, most[i]) - alpha[i]
            if step:
                alpha[i] += step
                weights += step * y[i] * x[i]
    return weights.astype(np.float32)


def learning_rows(docs: DataFrame, key: str = "doc_id") -> Column:
    """Rows that may be learned from: crc32 of the key as text, modulo 3, is not 1."""
    return ~held_out(key)


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def sample(labelled: DataFrame, lang: str, key: str, text: str, max_rows: int) -> tuple[list[str], DataFrame]:
    """The languages, and (lang, text) of at most max_rows rows, the same number for each language."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    langs = sorted(r[0] for r in rows.select(F.col(lang)).distinct().collect())  # as many as there are languages
    part = max(1, max_rows // max(1, len(langs)) // PARTS)
    mark = F.xxhash64(F.col(key).cast("string"), F.lit("language sample"))
    # Ranked without texts, so that what is sorted is small; one row a key, and none without one.
    lots = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.col(lang).alias("_lang"), F.xxhash64(text).alias("_hash"), mark.alias("_mark"))
    lots = lots.groupBy("_key").agg(F.min(F.struct("_lang", "_hash", "_mark")).alias("_one")).select("_key", "_one.*")
    lots = lots.withColumn("_part", F.pmod(F.hash("_mark"), F.lit(PARTS)))
    order = Window.partitionBy("_lang", "_part").orderBy("_mark", "_key")
    chosen = lots.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= part).select("_key", "_lang", "_hash")
    # At most one key for each place, so the broadcast is bounded; equal rows of a key are one row.
    same = (rows[key] == chosen["_key"]) & (rows[lang] == chosen["_lang"]) & (F.xxhash64(rows[text]) == chosen["_hash"])
    found = rows.join(F.broadcast(chosen), same, "left_semi").groupBy(F.col(key).alias("_key"), F.col(lang).alias("lang")).agg(F.first(text).alias("text"))
    return langs, found.select("lang", "text")


class Machines:
    """Weights of the family machines and of the machines for pairs of languages."""

    def __init__(self, langs: list[str], weights: dict[str, np.ndarray]):
        self.langs = langs
        self.families: dict[str, list[str]] = {}
        for lang in langs:
            self.families.setdefault(family_of(lang), []).append(lang)
        self.names = sorted(self.families)
        self.by_family = np.stack([weights[f"family {f}"] for f in self.names]) if len(self.names) > 1 else None
        self.pairs = {f: list(combinations(sorted(of), 2)) for f, of in self.families.items()}
        self.by_pair = {f: np.stack([weights[f"pair {a} {b}"] for a, b in pairs]) for f, pairs in self.pairs.items() if pairs}

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        x, score, family = np.append(features(text), np.float32(1)), 1.0, self.names[0]
        if self.by_family is not None:
            margins = self.by_family @ x
            best = int(np.argmax(margins))
            family = self.names[best]
            score = _chance(margins[best] - np.delete(margins, best).max())
        lang = self.families[family][0]
        if family in self.by_pair:
            votes, margins = dict.fromkeys(self.families[family], 0.0), self.by_pair[family] @ x
            for (a, b), margin in zip(self.pairs[family], margins):
                votes[a] += np.tanh(margin)
                votes[b] -= np.tanh(margin)
            lang = max(sorted(votes), key=votes.get)
            own = [m if lang == a else -m for (a, b), m in zip(self.pairs[family], margins) if lang in (a, b)]
            score *= _chance(min(own))
        return lang, float(score)


def _chance(margin: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(2 * margin, -40, 40))))


def fit(labelled: DataFrame, lang: str = "lang", key: str = "doc_id", text: str = "text", max_rows: int = MAX_ROWS) -> Machines:
    """Machines from labelled rows; see the module for what is learned from which."""
    langs, rows = sample(labelled, lang, key, text, max_rows)
    families = sorted({family_of(x) for x in langs})
    signs = [(f"family {f}", x, 1 if family_of(x) == f else -1) for f in families for x in langs] if len(families) > 1 else []
    for a, b in combinations(langs, 2):
        if family_of(a) == family_of(b):
            signs += [(f"pair {a} {b}", a, 1), (f"pair {a} {b}", b, -1)]
    if not signs:
        return Machines(langs, {})
    importable()
    spark = labelled.sparkSession

    @pandas_udf("binary")
    def packed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([features(t).tobytes() for t in texts], dtype=object)

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["sign", "x"])
        x = np.stack([np.frombuffer(v, np.float32) for v in rows["x"]])
        return pd.DataFrame({"machine": rows["machine"][:1], "weights": [fit_machine(x, rows["sign"].to_numpy(np.float64)).tobytes()]})

    uses = spark.createDataFrame(signs, "machine string, lang string, sign int")
    examples = rows.select("lang", packed("text").alias("x")).join(F.broadcast(uses), "lang").select("machine", "sign", "x")
    fitted = examples.groupBy("machine").applyInPandas(train, "machine string, weights binary").collect()  # one row a machine
    return Machines(langs, {r["machine"]: np.frombuffer(r["weights"], np.float32) for r in fitted})


def predict(docs: DataFrame, machines: Machines, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns, the predicted language and a score from 0 to 1. One narrow stage."""
    importable()
    shared = docs.sparkSession.sparkContext.broadcast(machines)

    @pandas_udf("lang string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machines = shared.value
        for texts in batches:
            yield pd.DataFrame([machines.predict(t) for t in texts], columns=["lang", "score"])

    both = docs.withColumn("_predicted", predicted(F.col(text)))
    kept = [c for c in docs.columns if c.lower() not in (lang.lower(), score.lower())]
    return both.select(*[F.col(f"`{c}`") for c in kept], F.col("_predicted.lang").alias(lang), F.col("_predicted.score").alias(score))
