"""Quality classifier: a weak-label model over heuristic labellers, then a hashed linear scorer.

1. Overlapping heuristic labellers vote good, bad or abstain on every whole
   document (``LABELLERS``).
2. Expectation-maximisation over the counts of all vote patterns (at most
   3 ** 7 of them, whatever the corpus) estimates the share of good documents and
   how each labeller votes on good and on bad ones, so its accuracy, without any
   label. The posterior of a pattern is the weak label of its documents.
3. The posteriors train a logistic scorer over hashed word shapes on a sample
   of at most ``sample`` documents, drawn by a hash from the whole corpus (of rows
   that repeat id and text, one).
4. Every document's whole text is scored in one pass; ``keep`` is score >= ``THRESHOLD``.

Documents without words (null, empty, white space) have no shapes: score 0,
not kept. Ids may be null or repeat: rows are judged one by one. An empty table
gives an empty result.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import textscan as ts
from .common import sampled
from .linear import Rows, fit, sigmoid

DIMS = 1 << 14
SAMPLE = 4096
THRESHOLD = 0.3  # below even odds: a clean document costs more than one that a later stage sees
SEPARATOR = ts.separators(lambda b: b != 32 and not 9 <= b <= 13)
FOLD = ts.fold_ascii()
PLAIN = np.arange(256, dtype=np.uint8)
ABSTAIN, BAD, GOOD = 0, 1, 2

# (name, statistic, bad beyond, good within, sign): thresholds of the labellers.
# With sign -1 small values are bad.
LABELLERS = [
    ("repeated_words", "repeat", 0.20, 0.05, 1),
    ("vocabulary", "variety", 0.50, 1.00, -1),
    ("capitals", "upper", 0.40, 0.15, 1),
    ("symbols", "symbol", 0.50, 0.10, 1),
    ("exclamation", "bang", 0.30, 0.05, 1),
    ("well_formed", "formed", 0.60, 0.90, -1),
    ("cell_marks", "pipe", 0.20, 0.02, 1),
]

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[128:] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*+<=>@[\\]^_`{}~"]] = True
_CLASS = PLAIN.copy()  # of word shapes: A, a, 0, any other character itself
_CLASS[65:91] = ord("A")
_CLASS[97:123] = ord("a")
_CLASS[128:] = ord("a")
_CLASS[48:58] = ord("0")
_ENDS = np.zeros(256, bool)  # bytes that a well-formed word may end with
_ENDS[[ord(c) for c in ".,;:?!)'\""]] = True


def _per_text(flags: np.ndarray, offset: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(flags))
    return (total[offset[1:]] - total[offset[:-1]]).astype(float)


def statistics(words: ts.Words) -> dict[str, np.ndarray]:
    """Statistics of each text that the labellers judge (0 words: all 0)."""
    n = np.diff(words.first).astype(float)
    per = np.maximum(n, 1)
    data = words.data
    folded = ts.Words(FOLD[data], words.start, words.end, words.first, words.offset)
    h = folded.hashes()
    again = np.append(False, h[1:] == h[:-1]) if len(h) else np.zeros(0, bool)
    again[words.first[:-1][words.first[:-1] < len(h)]] = False
    row = np.repeat(np.arange(len(n)), n.astype(int))
    order = np.lexsort((h, row))
    new = np.append(True, (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])) if len(h) else np.zeros(0, bool)
    distinct = np.bincount(row[order][new], minlength=len(n)) if len(h) else np.zeros(len(n))
    last = data[words.end - 1]
    formed = (_LETTER[data[words.start]] & (_LETTER[last] | (_ENDS[last] & _LETTER[data[np.maximum(words.end - 2, words.start)]]))) if len(h) else np.zeros(0, bool)
    return {
        "words": n,
        "repeat": _per_text(again, words.first) / per,
        "variety": distinct / per ** 0.8,
        "upper": _per_text(_UPPER[data], words.offset) / np.maximum(_per_text(_LETTER[data], words.offset), 1),
        "symbol": _per_text(_SYMBOL[data], words.offset) / per,
        "bang": _per_text(data == ord("!"), words.offset) / per,
        "formed": _per_text(formed, words.first) / per,
        "pipe": _per_text(data == ord("|"), words.offset) / per,
    }


def votes(stats: dict[str, np.ndarray]) -> np.ndarray:
    """Votes (texts x labellers); texts without words get abstentions."""
    out = np.zeros((len(stats["words"]), len(LABELLERS)), dtype=np.int8)
    for j, (_, name, bad, good, sign) in enumerate(LABELLERS):
        x = sign * stats[name]
        out[:, j] = np.where(x > sign * bad, BAD, np.where(x <= sign * good, GOOD, ABSTAIN))
    out[stats["words"] == 0] = ABSTAIN
    return out


def shapes(words: ts.Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashed features of each text: square roots of the shares of its word
    shapes (runs of one class of characters as one), and of words that repeat
    the word before."""
    data = _CLASS[words.data]
    starts = np.zeros(len(data), bool)
    starts[words.start] = True
    keep = starts.copy()
    keep[1:] |= data[1:] != data[:-1]
    rank = np.cumsum(keep) - 1
    up, down = ts._power_table(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=ts.U64)
    np.cumsum(np.where(keep, ts.BYTE_VALUE[data] * up[np.maximum(rank, 0)], ts.U64(0)), out=total[1:])
    shape = ts.mix((total[words.end] - total[words.start]) * down[rank[words.start]]) if len(words.start) else np.zeros(0, ts.U64)
    h = ts.Words(FOLD[words.data], words.start, words.end, words.first, words.offset).hashes()
    again = np.append(False, h[1:] == h[:-1]) if len(h) else np.zeros(0, bool)
    code = (shape % ts.U64(DIMS - 1)).astype(np.int64)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if a == b:
            out.append((np.zeros(0, np.int64), np.zeros(0)))
            continue
        index, count = np.unique(code[a:b], return_counts=True)
        repeats = int(again[a + 1:b].sum())
        if repeats:
            index, count = np.append(index, DIMS - 1), np.append(count, repeats)
        out.append((index, np.sqrt(count / (b - a))))
    return out


@dataclass
class Model:
    good: float             # estimated share of good documents
    emits: np.ndarray       # class (bad, good) x labeller x vote
    weight: np.ndarray      # of the scorer, bias last

    def posterior(self, pattern: np.ndarray) -> np.ndarray:
        """P(good) of each row of votes."""
        log = [np.log(p) + sum(np.log(self.emits[c, j, pattern[:, j]]) for j in range(pattern.shape[1])) for c, p in ((0, 1 - self.good), (1, self.good))]
        return sigmoid(log[1] - log[0])

    def accuracy(self) -> dict[str, float]:
        """Estimated accuracy of each labeller where it votes."""
        prior = np.array([1 - self.good, self.good])
        right = prior[0] * self.emits[0, :, BAD] + prior[1] * self.emits[1, :, GOOD]
        voted = (prior[:, None] * (self.emits[:, :, BAD] + self.emits[:, :, GOOD])).sum(axis=0)
        return {name: float(r / v) for (name, *_), r, v in zip(LABELLERS, right, voted)}


def expectation_maximisation(pattern: np.ndarray, count: np.ndarray, rounds: int = 20_000) -> tuple[float, np.ndarray]:
    """(share of good, emissions) from vote patterns and their counts.

    Starts from the vote majority; stops when the posteriors stand still, and warns
    when they still move after ``rounds``."""
    bad, good = (pattern == BAD).sum(axis=1), (pattern == GOOD).sum(axis=1)
    post = np.where(bad >= 2, 0.1, np.where((bad == 0) & (good > 0), 0.9, 0.5))
    share, emits = 0.5, np.full((2, pattern.shape[1], 3), 1 / 3)
    for _ in range(rounds):
        for c, weight in ((0, count * (1 - post)), (1, count * post)):
            for vote in (ABSTAIN, BAD, GOOD):
                emits[c, :, vote] = (((pattern == vote) * weight[:, None]).sum(axis=0) + 0.5) / (weight.sum() + 1.5)
        share = float((count * post).sum() + 1) / (count.sum() + 2)
        new = Model(share, emits, np.zeros(0)).posterior(pattern)
        if np.abs(new - post).max(initial=0) < 1e-6:
            break
        post = new
    else:
        warnings.warn(f"labeller accuracies still move after {rounds} rounds", RuntimeWarning, stacklevel=2)
    return share, emits


def _judge(what: str, model, schema: pa.Schema):
    """Task: 'votes' (pattern as text), 'features' or 'score' of every row's text."""

    def run(batches):
        m: Model | None = model.value if model is not None else None
        for batch in batches:
            for part in ts.slices(batch, "text"):
                words = ts.scan(part.column("text"), SEPARATOR, PLAIN)
                pattern = votes(statistics(words))
                cols = {"pattern": pa.array(["".join(map(str, v)) for v in pattern.tolist()], pa.string())}
                if what == "features":
                    made = shapes(words)
                    cols |= {"index": pa.array([i.astype("<i4").tobytes() for i, _ in made], pa.binary()), "value": pa.array([v.astype("<f4").tobytes() for _, v in made], pa.binary())}
                if what == "score":
                    made = Rows.of(shapes(words))
                    score = np.where(np.diff(words.first) > 0, sigmoid(made.dot(m.weight) + m.weight[-1]), 0.0)
                    cols |= {"weak_label": pa.array(m.posterior(pattern)), "score": pa.array(score)}
                yield pa.RecordBatch.from_arrays([cols[f.name] if f.name in cols else part.column(f.name) for f in schema], schema=schema)

    return run


def _run(df: DataFrame, what: str, model, more: str, keep: bool = False) -> DataFrame:
    kind = T.StructType((df.schema.fields if keep else []) + T.StructType.fromDDL(more).fields)
    return df.mapInArrow(_judge(what, model, to_arrow_schema(kind)), kind)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, sample: int = SAMPLE) -> Model:
    """Fit labeller accuracies on all documents and the scorer on at most ``sample`` of them."""
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    seen = _run(texts, "votes", None, "pattern string").groupBy("pattern").count().collect()
    total = sum(r["count"] for r in seen)
    if not total:
        return Model(0.5, np.full((2, len(LABELLERS), 3), 1 / 3), np.zeros(DIMS + 1))
    pattern = np.array([[int(c) for c in r.pattern] for r in seen])
    share, emits = expectation_maximisation(pattern, np.array([r["count"] for r in seen], dtype=float))
    model = Model(share, emits, np.zeros(DIMS + 1))

    keyed = docs.select(F.xxhash64(F.col(id_col), F.col(text_col).cast("string")).alias("key"), F.col(text_col).cast("string").alias("text"))
    rows = _run(sampled(keyed, "key", total, sample).select("text"), "features", None, "pattern string, index binary, value binary").where(F.length("index") > 0).collect()
    x = Rows.of([(np.frombuffer(r["index"], "<i4"), np.frombuffer(r["value"], "<f4")) for r in rows])
    y = model.posterior(np.array([[int(c) for c in r.pattern] for r in rows]).reshape(-1, len(LABELLERS)))
    model.weight = fit(x, y, DIMS, l2=1e-4, steps=200, rate=0.2)
    return model


def scored(docs: DataFrame, model: Model, *own: Column, text_col: str = "text") -> DataFrame:
    """``own`` columns with the text, pattern (a digit per labeller: 0 abstains,
    1 bad, 2 good), weak_label and score."""
    df = docs.select(*own, F.col(text_col).cast("string").alias("text"))
    return _run(df, "score", docs.sparkSession.sparkContext.broadcast(model), "pattern string, weak_label double, score double", keep=True)


def judge(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", *, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: id, pattern, weak_label, score, keep."""
    return scored(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")), model, F.col("id"), text_col="t").select(F.col("id").alias(id_col), "pattern", "weak_label", "score", (F.col("score") >= threshold).alias("keep"))


def kept(docs: DataFrame, model: Model, text_col: str = "text", *, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier keeps, in the input's columns."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col] or [F.lit(0).alias("none")]
    found = scored(docs, model, F.struct(*others).alias("row"), text_col=text_col).where(F.col("score") >= threshold)
    return found.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])
