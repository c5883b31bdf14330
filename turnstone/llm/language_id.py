"""Language identification by hierarchical discrimination.

First linear support vector machines, one for each family against the rest, tell the
family; then machines for each pair of the family's languages vote.  Features are
hashed byte pairs and triples of the lower-cased letters, as square roots of their
shares, so that a text's length does not matter.

Training takes a bounded, documented sample: at most ``sample`` texts of each language,
those whose hash of id and text is smallest; equal rows count once.  The model is
``dimensions`` weights for each family and each pair within one, which bounds what is
broadcast; prediction reads nothing but the text.

A letter is a character of Unicode category L.

Cases: null texts and texts without a letter are ``und`` with score 0; with no labelled
text at all everything is ``und``; a single language needs no machine; texts that are equal get
equal results; ties go to the language that sorts first; repeated rows give one result each; a null id stays null
and is never trained on; other columns are ignored; an empty table gives an empty
result; long texts are read whole.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstone.llm._shared import pack, texts, unpack

# Families of the languages with two-letter codes; others are families of their own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi".split(),
    "romance": "ca es fr gl it oc pt ro".split(),
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk".split(),
    "baltic": "lt lv".split(),
    "finnic": "et fi".split(),
    "celtic": "br cy ga gd".split(),
    "turkic": "az kk ky tk tr uz".split(),
    "indo-aryan": "bn gu hi mr ne pa ur".split(),
    "semitic": "am ar he mt".split(),
    "malayic": "id ms".split(),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}
DIMENSIONS, SAMPLE = 1 << 14, 300
#: Bytes that no word holds become spaces.
PLAIN = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    """True for ids of the fold that is kept from training."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def family(lang: str) -> str:
    return FAMILY_OF.get(lang.lower().replace("_", "-").split("-")[0], f"only {lang}")


def counts(text: str, dimensions: int) -> np.ndarray:
    """How often each hashed pair and triple of bytes comes."""
    raw = text.lower().encode("utf-8", "surrogatepass").translate(PLAIN)
    b = np.frombuffer(b" " + b" ".join(raw.split()) + b" ", np.uint8).astype(np.uint32)
    total = np.zeros(dimensions, np.int64)
    shift = np.uint32(32 - (dimensions - 1).bit_length())
    for at in range(0, len(b), 1 << 20):
        c = b[at : at + (1 << 20) + 2]
        pair = c[:-1] * np.uint32(0x9E3779B1) + c[1:] * np.uint32(0x85EBCA77)
        triple = pair[:-1] * np.uint32(0xC2B2AE3D) + c[2:] * np.uint32(0x27D4EB2F)
        for h in (pair[: 1 << 20], triple[: 1 << 20]):
            total += np.bincount((h ^ h >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> shift, minlength=dimensions)
    return total


def features(n: np.ndarray) -> np.ndarray:
    return np.sqrt(n / max(1, n.sum())).astype(np.float32)


def train_machine(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 12) -> np.ndarray:
    """A linear support vector machine with bias as last weight, by dual coordinate descent in a fixed order."""
    w, bias, alpha = np.zeros(x.shape[1], np.float32), 0.0, [0.0] * len(x)
    sign, square = y.tolist(), ((x * x).sum(1) + 1).tolist()
    order = np.random.default_rng(0)
    for _ in range(rounds):
        changed = False
        for i in order.permutation(len(x)).tolist():
            margin = sign[i] * (float((x[i] * w).sum()) + bias)
            new = min(cost, max(0.0, alpha[i] - (margin - 1) / square[i]))
            if abs(new - alpha[i]) > 1e-6:
                step = (new - alpha[i]) * sign[i]
                w += np.float32(step) * x[i]
                bias += step
                alpha[i], changed = new, True
        if not changed:
            break
    return np.append(w, np.float32(bias))


class Model:
    """Machines of families and pairs, in columns of one matrix."""

    def __init__(self, x: np.ndarray, langs: list[str], cost: float = 10.0):
        self.langs = sorted(set(langs))
        self.families = sorted({family(v) for v in self.langs})
        self.members = {f: [v for v in self.langs if family(v) == f] for f in self.families}
        self.pairs = [p for f in self.families for p in combinations(self.members[f], 2)]
        lang, fam = np.array(langs), np.array([family(v) for v in langs])
        columns = []
        if len(self.families) > 1:
            columns += [train_machine(x, np.where(fam == f, 1, -1), cost) for f in self.families]
        for a, b in self.pairs:
            own = (lang == a) | (lang == b)
            columns.append(train_machine(x[own], np.where(lang[own] == a, 1, -1), cost))
        self.weights = np.stack(columns, axis=1) if columns else np.zeros((x.shape[1] + 1, 0), np.float32)

    def predict(self, n: np.ndarray) -> tuple[str, float]:
        found = np.flatnonzero(n)
        values = np.sqrt(n[found] / max(1, n.sum()))
        margins = (values @ self.weights[found] + self.weights[-1]).astype(np.float64)
        score, at, best = 1.0, 0, self.families[0]
        if len(self.families) > 1:
            at = len(self.families)
            best = self.families[int(np.argmax(margins[:at]))]
            score = certainty(margins[:at].max())
        members = self.members[best]
        votes, sums = dict.fromkeys(members, 0), dict.fromkeys(members, 0.0)
        for (a, b), m in zip(self.pairs, margins[at:]):
            if a in votes:
                votes[a if m >= 0 else b] += 1
                sums[a] += m
                sums[b] -= m
        lang = min(members, key=lambda v: (-votes[v], -sums[v], v))
        own = [certainty(m if a == lang else -m) for (a, b), m in zip(self.pairs, margins[at:]) if lang in (a, b)]
        return lang, float(score * (min(own) if own else 1.0))


def certainty(margin: float) -> float:
    return float(1 / (1 + np.exp(-2 * np.clip(margin, -50, 50))))


def training_sample(docs: DataFrame, sample: int) -> DataFrame:
    """The ``sample`` texts of each language with the smallest hashes; never those held out.

    A range of hashes in which twice as many are expected is read first, so that what is sorted stays small
    however large a language is.
    """
    own = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    own = own.select("doc_id", "text", "lang", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)).alias("_low"))
    sizes = own.groupBy("lang").agg(F.approx_count_distinct("_low").alias("n"))
    bound = (F.lit(float(1 << 40)) * (2 * sample + 40) / F.col("n")).cast("long")
    near = own.join(F.broadcast(sizes.select("lang", bound.alias("_bound"))), "lang").where(F.col("_low") < F.col("_bound"))
    once = near.groupBy("lang", "_low").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    return once.withColumn("_at", F.row_number().over(Window.partitionBy("lang").orderBy("_low"))).where(F.col("_at") <= sample).select("doc_id", "text", "lang")


def train(docs: DataFrame, dimensions: int = DIMENSIONS, sample: int = SAMPLE) -> Model | None:
    """A model of ``docs`` (doc_id, text, lang); None without a labelled text that has a letter."""

    def run(batches):
        for batch in batches:
            langs = batch.column(2).to_pylist()
            rows = [(i, v, np.flatnonzero(n), n) for (i, t), v in zip(texts([batch]), langs) if has_letter(t) for n in [counts(t, dimensions)]]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows]), pa.array([pack(r[2].astype(np.uint32), r[3][r[2]].astype(np.uint32)) for r in rows], pa.binary())], ["doc_id", "lang", "data"])

    rows = sorted(((r["doc_id"], r["lang"], bytes(r["data"])) for r in training_sample(docs, sample).mapInArrow(run, "doc_id long, lang string, data binary").toLocalIterator()), key=lambda r: r)
    if not rows:
        return None
    x = np.zeros((len(rows), dimensions), np.float32)
    for k, (_, _, data) in enumerate(rows):
        found, n = unpack(data)
        x[k, found] = np.sqrt(n / n.sum())
    return Model(x, [r[1] for r in rows])


def identify(docs: DataFrame, dimensions: int = DIMENSIONS, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs`` (doc_id, text, lang)."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, dimensions, sample))

    def run(batches):
        m = model.value
        for batch in batches:
            out = [m.predict(counts(t, dimensions)) if m and has_letter(t) else ("und", 0.0) for _, t in texts([batch])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
