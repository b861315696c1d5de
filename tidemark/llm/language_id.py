"""Language identification by prediction by partial matching.

Each language has a byte context tree of orders 3, 2, 1 and 0, frozen after training. A byte
costs -log2 of its share among the bytes that followed its context; where the context never
saw it, the cost of an escape (distinct / (total + distinct)) and then its cost in the next
shorter context, down to 8 bits. The language with the shortest code of the whole text wins.

As the statistics are frozen, the escapes are resolved before scoring: every context of
length 3 points to one row of costs, of itself or of its longest suffix that training saw,
and a text is scored by one look-up per byte. The model is fit on at most about
``TRAIN_DOCS`` labelled documents per language, drawn by a hash of the id; this bounds the
rows that come to the driver and the table that goes back.

Null text and text without a letter get ``und`` and score 0, and so does everything if no
document is labelled. A null id is neither held out nor learned from. Rows that repeat are
judged row by row; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidemark.llm.common import slices

TRAIN_DOCS = 4000
USUAL, SPARE, SLACK = 0.99, 1.25, 100.0
FOLDS = 5
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
PAD = b"\n\n\n"
CHUNK = 1 << 20


def held_out() -> Column:
    """Whether a document is never learned from; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0


def training_rows(docs: DataFrame, most: int = TRAIN_DOCS) -> DataFrame:
    """lang, text: labelled documents outside the held-out fold, about ``most`` per language."""
    labelled = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()  # one per language
    numbers = {row["lang"]: row["n"] for row in counted}
    if not numbers:
        return labelled.select("lang", "text").limit(0)
    shares = {lang: min(1.0, most / n) for lang, n in numbers.items()}
    share = F.create_map(*(F.lit(x) for pair in shares.items() for x in pair))
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30)
    return labelled.filter(drawn).select("lang", "text")


def _grams(text: bytes) -> np.ndarray:
    """Each byte with the three before it, as one number."""
    data = np.frombuffer(PAD + text, np.uint8).astype(np.uint32)
    return data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, 200):
            langs, texts = batch["lang"].to_pylist(), batch["text"].to_pylist()
            for lang in sorted(set(langs)):
                found = [_grams(t.lower().encode()) for own, t in zip(langs, texts) if own == lang]
                grams, numbers = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(grams), pa.string()),
                        pa.array(grams.astype(np.int64)),
                        pa.array(numbers.astype(np.int64)),
                    ],
                    names=["lang", "gram", "n"],
                )


class Model:
    """Frozen costs: ``rows`` maps a context of three symbols to a row of ``costs``."""

    def __init__(self, langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray):
        self.langs = langs
        parts = np.stack([gram >> shift & 255 for shift in (24, 16, 8, 0)])
        seen = np.unique(parts)
        # Symbol 0 stands for all bytes that training did not see.
        self.symbol = np.zeros(256, np.int64)
        self.symbol[seen] = np.arange(1, len(seen) + 1)
        parts, size = self.symbol[parts], len(seen) + 1
        self.size = size
        tables: list[np.ndarray] = []
        rows = np.zeros(1, np.int64)  # context -> row over all tables
        below = np.full((1, size, len(langs)), np.float32(8))  # costs by row, one order lower
        for order in range(4):
            context = np.zeros(len(n), np.int64)
            for part in parts[3 - order : 3]:
                context = context * size + part
            kinds, place = np.unique(context, return_inverse=True)
            counts = np.zeros((len(kinds), size, len(langs)), np.float32)
            np.add.at(counts, (place, parts[3], lang), n)
            total, distinct = counts.sum(1), (counts > 0).sum(1)
            whole = np.maximum(total + distinct, 1)
            with np.errstate(divide="ignore"):
                escape = np.where(total > 0, -np.log2(distinct / whole), 0.0)
                direct = -np.log2(counts / whole[:, None, :])
            # The suffix of a context that training saw was seen too.
            lower = below[rows[kinds % len(rows)]]
            costs = np.where(counts > 0, direct, escape[:, None, :] + lower)
            start = sum(map(len, tables))
            tables.append(costs)
            below = np.concatenate(tables)
            # A context that training did not see points where its suffix points.
            rows = np.tile(rows, size) if order else rows
            rows[kinds] = start + np.arange(len(kinds))
        self.rows = rows.astype(np.int32) * size
        self.costs = below.reshape(-1, len(langs)).astype(np.float32)

    def bits(self, text: bytes) -> np.ndarray:
        """Code length of the text in each language."""
        return self.all_bits([text])[0]

    def all_bits(self, texts: list[bytes]) -> np.ndarray:
        """Code lengths of several texts; long input is scored in chunks."""
        out = np.zeros((len(texts), len(self.langs)))
        lengths = np.array([len(t) for t in texts], np.int64)
        data = self.symbol.astype(np.int32)[
            np.frombuffer(b"".join(PAD + t for t in texts), np.uint8)
        ]
        ends = np.cumsum(lengths + 3)
        owner_starts = ends - lengths
        for at in range(0, max(len(data) - 3, 0), CHUNK):
            part = data[at : at + CHUNK + 3]
            if len(part) <= 3:
                break
            size = self.size
            context = (part[:-3] * size + part[1:-2]) * size + part[2:-1]
            picked = self.costs[self.rows[context] + part[3:]]
            # Rows at..at+len stand for the bytes from at + 3 on; a text has its own run.
            first = np.clip(owner_starts - 3 - at, 0, len(picked))
            last = np.clip(ends - 3 - at, 0, len(picked))
            own = np.flatnonzero(last > first)
            if len(own):
                edges = np.stack([first[own], last[own]], 1).ravel()
                padded = np.concatenate([picked, np.zeros((1, picked.shape[1]), np.float32)])
                sums = np.add.reduceat(padded, np.minimum(edges, len(picked)), axis=0)
                out[own] += sums[::2]
        return out


def train(docs: DataFrame, most: int = TRAIN_DOCS) -> Model | None:
    """Fit the context trees; None without labelled documents."""
    counted = training_rows(docs, most).mapInArrow(_count, "lang string, gram long, n long")
    found = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    if not found.num_rows:
        return None
    langs = sorted(set(found["lang"].to_pylist()))
    codes = np.searchsorted(np.array(langs), np.array(found["lang"].to_pylist()))
    return Model(langs, codes, found["gram"].to_numpy(), found["n"].to_numpy())


def identify(
    docs: DataFrame,
    model: Model | None,
    pred: str = "lang_pred",
    likely: str = "score",
    rate: str | None = None,
) -> DataFrame:
    """Every column of ``docs`` and these two; columns of their names are replaced.

    With ``rate`` a third one: bits of the best code per byte, null for an unknown language.
    """
    kept = docs.drop(pred, likely, *([rate] if rate else []))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for whole in batches:
            for batch in slices(whole, 100):
                texts = batch["text"].to_pylist()
                preds, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
                rates: list[float | None] = [None] * len(texts)
                places = [i for i, t in enumerate(texts) if t and LETTER.search(t)]
                if found and places:
                    coded = [texts[i].lower().encode() for i in places]
                    bits = found.all_bits(coded)
                    best = bits.argmin(1)
                    odds = np.exp2(-(bits - bits.min(1, keepdims=True)))
                    for i, place, score in zip(places, best, 1 / odds.sum(1)):
                        preds[i], scores[i] = found.langs[place], float(score)
                    for i, text, cost in zip(places, coded, bits.min(1)):
                        rates[i] = float(cost) / len(text)
                added = [pa.array(preds, pa.string()), pa.array(scores, pa.float64())]
                added += [pa.array(rates, pa.float64())] if rate else []
                yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=out.fieldNames())

    out = StructType(
        [
            *kept.schema.fields,
            StructField(pred, StringType()),
            StructField(likely, DoubleType()),
            *([StructField(rate, DoubleType())] if rate else []),
        ]
    )
    return kept.mapInArrow(predict, out)


def usual_rates(docs: DataFrame, model: Model | None) -> dict[str, float]:
    """Per language the bits a byte that nearly all of its held-out labelled texts stay below.

    ``USUAL`` of the texts, and ``SPARE`` on top. A language without such texts has no bound.
    """
    known = docs.filter(F.coalesce(held_out(), F.lit(False)) & F.col("lang").isNotNull())
    told = identify(known.select("text", "lang"), model, "_td_pred", "_td_score", "_td_rate")
    right = told.filter("_td_pred = lang").groupBy("lang")
    found = right.agg(F.percentile_approx("_td_rate", USUAL).alias("rate")).collect()
    return {row.lang: row.rate * SPARE for row in found}  # one row per language


def in_known_language(
    docs: DataFrame, model: Model | None, bounds: dict[str, float], least_score: float
) -> DataFrame:
    """The documents in one of the learned languages, with their own columns.

    A text without a letter, without a likely language, or whose code is longer than the
    bound of its language allows is in none. ``SLACK`` bits spare short texts.
    """
    judged = identify(docs, model, "_td_pred", "_td_score", "_td_rate")
    bound = F.lit(None).cast("double")
    for lang, most in bounds.items():
        bound = F.when(F.col("_td_pred") == lang, most).otherwise(bound)
    size = F.octet_length(F.lower("text"))
    short = F.col("_td_rate") * size <= bound * size + SLACK
    good = (F.col("_td_pred") != UNKNOWN) & (F.col("_td_score") >= least_score)
    return judged.filter(good & F.coalesce(short, F.lit(True))).select(docs.columns)


def predict_languages(docs: DataFrame, most: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each document."""
    asked = docs.select(
        "doc_id", "text", F.coalesce(held_out(), F.lit(False)).alias("held_out")
    )
    return identify(asked, train(docs, most)).drop("text")
