"""Toxicity: a weighted lexicon matched by Aho-Corasick.

Texts are folded first: compatibility forms, case, accents, look-alike letters of other
scripts, signs without width, and digits or marks that stand for letters inside a word. Where
they end a word, or '!' stands between letters, the text is matched in both readings. The
lexicon holds whole words and word beginnings with weights, learned from labelled rows as
smoothed log-odds of the share of toxic and of clean documents that have them, where near copies
(texts with equal least hashes of word runs, and whatever they link) count once. Exception
phrases (a listed term with its neighbour) that occur in clean documents only take a hit out
again; a caller may add more. The weights of all hits are summed, normalised by the text's
number of words, and put on a scale from 0 to 1 by a logistic curve fitted on the same labelled rows.

Training reads a bounded sample, at most `SAMPLE_ROWS` labelled rows chosen by a hash of
their id. The lexicon keeps the `LEXICON_TERMS` heaviest terms and as many phrases. Scoring reads
every text whole.

Defined results: a null or empty text has no hit and gets the score of a text without hits;
a doc_id with several labels counts as toxic if one of them says so, one with several texts
teaches by the least of them; null labels teach nothing; without any toxic or any clean row every score is 0; repeated rows get a row each;
an empty table gives an empty table; other columns are not read.
"""

import hashlib
import math
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levyscan.llm.common import in_share, only, shares, slices, stage

SAMPLE_ROWS = 12_000
LEXICON_TERMS = 3_000
BEGINNINGS = (4, 5, 6)
LEAST_DOCS = 3  # near copies count as one
BANDS, BAND_HASHES, SHINGLE = 6, 4, 5  # near copies agree in a band of least hashes of word runs
LEAST_WEIGHT = 2.5
SLICE_BYTES = 1 << 20  # of text at once
COUNTED_AT_ONCE = 50_000  # features that a task counts together

# Letters of other scripts that look like Latin ones, each under its look.
LOOK_ALIKES = {
    "a": "аα", "b": "вьβ", "c": "сϲ", "d": "ԁ", "e": "еєε", "g": "ɡ", "h": "һнη", "i": "іιӏ", "j": "јϳ", "k": "кκ",
    "l": "ⅼ", "m": "мⅿ", "n": "пո", "o": "оοσօ", "p": "рρ", "q": "ԛ", "r": "гⲅ", "s": "ѕ", "t": "тτ", "u": "υս",
    "v": "ѵν", "w": "ԝω", "x": "хχ", "y": "уγү", "z": "ᴢ",
}
# Digits and marks that stand for a letter.
DIGIT_LETTERS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}
NO_WIDTH = "\u00ad\u200b\u200c\u200d\u2060\ufeff"

_TABLE = {ord(c): latin for latin, many in LOOK_ALIKES.items() for c in many} | {ord(c): None for c in NO_WIDTH}
_INSIDE = regex.compile(r"(?<=[a-z])[01345789@$]+(?=[a-z])|(?<![a-z0-9@$])[01345789@$](?=[a-z])")
_AT_END = regex.compile(r"(?<=[a-z])(?:[01345789@$]+(?![a-z0-9@$])|!+(?=[a-z]))")
_WORD = regex.compile(r"[a-z\p{L}]+")


class _Folder(dict):
    """Sign by sign: what a sign becomes, worked out once."""

    def __missing__(self, code: int):
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c)).lower()
        plain = plain.translate(_TABLE)
        self[code] = out = plain if plain or chr(code) in NO_WIDTH or unicodedata.combining(chr(code)) else chr(code)
        return out


_folder = _Folder(_TABLE)


def fold(text: str) -> str:
    low = text.lower()
    if not low.isascii():
        low = low.translate(_folder)
    return _INSIDE.sub(lambda m: "".join(DIGIT_LETTERS[c] for c in m[0]), low)


def _readings(folded: str) -> list[str]:
    """The folded text, and, if it differs, that with signs at the ends of words read as letters;
    both have the same length."""
    other = _AT_END.sub(lambda m: "".join(DIGIT_LETTERS.get(c, "i") for c in m[0]), folded)
    return [folded] if other == folded else [folded, other]


def _features(word: str) -> list[str]:
    return [f"={word}", *[f"^{word[:k]}" for k in BEGINNINGS if len(word) > k]]


@dataclass
class Lexicon:
    """Weights of terms ('=word' or '^beginning'), exception phrases, and the curve."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, ...] = (-50.0, 0.0, 0.0)

    def key(self) -> tuple:
        return tuple(sorted(self.weights.items())), self.exceptions


@lru_cache(maxsize=4)
def _automaton(key: tuple):
    weights, exceptions = key
    found = ahocorasick.Automaton()
    for term, weight in weights:
        known = found.get(term[1:], {})
        known[term[0]] = weight
        found.add_word(term[1:], known | {"size": len(term) - 1})
    for phrase in exceptions:
        known = found.get(phrase, {})
        found.add_word(phrase, known | {"!": 0.0, "size": len(phrase)})
    if len(found):
        found.make_automaton()
    return found


def hits(folded: str, lexicon: Lexicon) -> list[tuple[int, int, float]]:
    """(start, end, weight) of the heaviest term at each word, without those that an
    exception phrase covers."""
    machine = _automaton(lexicon.key())
    if not len(machine):
        return []
    best: dict[int, tuple[int, float]] = {}
    spared: list[tuple[int, int]] = []
    for text in _readings(folded):
        for last, kinds in machine.iter(text):
            start, end = last - kinds["size"] + 1, last + 1
            if start and text[start - 1].isalpha():
                continue
            closed = end == len(text) or not text[end].isalpha()
            if "!" in kinds and closed:
                spared.append((start, end))
            weight = kinds.get("=", -math.inf) if closed else -math.inf
            weight = max(weight, kinds.get("^", -math.inf) if not closed else -math.inf)
            if weight > best.get(start, (0, -math.inf))[1]:
                best[start] = (end, weight)
    return [(s, e, w) for s, (e, w) in sorted(best.items()) if not any(a <= s and e <= b for a, b in spared)]


def measures(text: str | None, lexicon: Lexicon) -> tuple[float, float]:
    """The summed weight of all hits, and that per 100 words, both as logarithms."""
    folded = fold(text or "")
    total = sum(w for _, _, w in hits(folded, lexicon))
    words = max(1, len(folded.split()))
    return math.log1p(total), math.log1p(100.0 * total / words)


def score(text: str | None, lexicon: Lexicon) -> float:
    a, b = measures(text, lexicon)
    z = lexicon.curve[0] + lexicon.curve[1] * a + lexicon.curve[2] * b
    return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, z))))


def sample(docs: DataFrame, labels: DataFrame, use: Column, rows: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(text, toxic) of at most `rows` labelled documents for which `use` holds."""
    marked = only(labels, id=id_col, toxic=label_col).filter("id is not null and toxic is not null")
    marked = marked.withColumn("h", F.xxhash64(F.lit("toxic"), "id"))
    marked = marked.withColumnRenamed("id", id_col).filter(use).withColumnRenamed(id_col, "id")
    for share in shares(labels.count(), rows):
        one = marked.filter(in_share(F.col("h"), share)).groupBy("id", "h").agg(F.max("toxic").cast("int").alias("toxic"))
        chosen = stage(one.orderBy("h").limit(rows), "toxic-labels")
        if chosen.count() == rows:
            break
    texts = only(docs, id=id_col, text=text_col)
    met = texts.join(F.broadcast(chosen), "id")  # `rows` bounds it
    return met.groupBy("id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")


_MULTIPLY, _ADD = (np.random.default_rng(s).integers(1, 1 << 63, BANDS * BAND_HASHES, dtype=np.uint64) | np.uint64(1) for s in (1, 2))


def _number(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def bands(folded: str) -> list[int]:
    """A number per band; texts with most of their word runs in common agree in one."""
    words = folded.split()
    runs = {" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}
    hashed = np.array([_number(r.encode("utf-8", "replace")) for r in runs], dtype=np.int64).astype(np.uint64)
    least = np.array([(hashed * m + a).min() for m, a in zip(_MULTIPLY, _ADD)], dtype=np.uint64)
    return [_number(bytes([b]) + least[b * BAND_HASHES : (b + 1) * BAND_HASHES].tobytes()) for b in range(BANDS)]


def near_copies(rows: list[tuple[int, list[int]]]) -> dict[int, int]:
    """The class of each text (by its number) that shares a band, at one or more removes."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    first: dict[int, int] = {}
    for text, numbers in rows:
        for n in numbers:
            a, b = top(text), top(first.setdefault(n, text))
            root[max(a, b)] = min(a, b)
    return {text: top(text) for text, _ in rows}


def _document_counts(rows: DataFrame, found: Callable[[str], set[str]], class_of: dict[int, int], repeated: frozenset[int]) -> dict[str, tuple[int, int]]:
    """How many toxic and how many clean classes of near copies have each of the features that
    `found` lists for a text; features of few classes stay behind."""
    most = COUNTED_AT_ONCE

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # (toxic, class) and its features; a class of one row needs no telling apart.
        counts: dict[tuple[int, int | None], Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (toxic, kind), n in counts.items():
                size = len(n)
                yield pa.record_batch(
                    {
                        "feature": pa.array(list(n), pa.string()),
                        "toxic": pa.array([toxic] * size, pa.int32()),
                        "class": pa.array([kind] * size, pa.int64()),
                        "n": pa.array(list(n.values()) if kind is None else [1] * size, pa.int64()),
                    }
                )
            counts.clear()

        for batch in slices(batches, 0, SLICE_BYTES):
            for text, toxic, number in zip(*(batch.column(i).to_pylist() for i in range(3))):
                kind = class_of[number]
                counts.setdefault((1 if toxic else 0, kind if kind in repeated else None), Counter()).update(found(text or ""))
                if sum(map(len, counts.values())) > most:
                    yield from flush()
        yield from flush()

    told = stage(rows.mapInArrow(counted, "feature string, toxic int, class long, n long"), "toxic-features")
    once = told.filter("class is null").unionByName(told.filter("class is not null").distinct())
    sums = once.groupBy("feature").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c")
    )
    top = sums.filter(F.col("t") >= LEAST_DOCS).orderBy((F.col("t") / (F.col("c") + 1.0)).desc(), F.desc("t"), "feature").limit(4 * LEXICON_TERMS)
    return {r.feature: (r.t, r.c) for r in top.collect()}


def _fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton's steps with a little shrinkage."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    shrink = np.diag([1e-3, 1e-2, 1e-2]) * len(x) / 100
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + shrink + 1e-6 * np.eye(3), x.T @ (y - p) - shrink @ w)
        w += step
        if abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


def train(
    docs: DataFrame,
    labels: DataFrame,
    use: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    exceptions: tuple[str, ...] = (),
    sample_rows: int = SAMPLE_ROWS,
) -> Lexicon:
    """A lexicon from the labelled rows where `use` (an expression over the id) holds."""
    kept = stage(sample(docs, labels, use, sample_rows, id_col, text_col, label_col), "toxic-sample")

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0, SLICE_BYTES):
            folded = [fold(t or "") for t in batch.column(0).to_pylist()]
            numbers = pa.array([_number(f.encode("utf-8", "replace")) for f in folded], pa.int64())
            yield pa.record_batch({"text": batch.column(0), "toxic": batch.column(1), "number": numbers, "bands": pa.array(map(bands, folded), pa.list_(pa.int64()))})

    rows = stage(kept.mapInArrow(numbered, "text string, toxic int, number long, bands array<long>"), "toxic-numbered")
    met = rows.groupBy("number").agg(F.min("bands").alias("bands"), F.max("toxic").alias("t"), F.min("toxic").alias("c"), F.count("*").alias("n")).collect()
    class_of = near_copies(sorted((r.number, r.bands) for r in met))
    n_toxic, n_clean = len({class_of[r.number] for r in met if r.t == 1}), len({class_of[r.number] for r in met if r.c == 0})
    if not n_toxic or not n_clean:
        return Lexicon()
    sizes = Counter()
    for r in met:
        sizes[class_of[r.number]] += r.n
    repeated = frozenset(c for c, n in sizes.items() if n > 1)
    rows = rows.select("text", "toxic", "number")

    def words_of(text: str) -> set[str]:
        return {f for w in set(_WORD.findall(fold(text))) if len(w) > 2 for f in _features(w)}

    def weight(t: int, c: int) -> float:
        return math.log((t + 0.5) / (n_toxic + 1)) - math.log((c + 0.5) / (n_clean + 1))

    counts = _document_counts(rows, words_of, class_of, repeated)
    # A term must be much likelier in toxic documents, by more than chance would have it.
    sure = {
        f: weight(t, c)
        for f, (t, c) in counts.items()
        if weight(t, c) >= LEAST_WEIGHT and weight(t, c) > 2.4 * math.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))
    }
    chosen = dict(sorted(sure.items(), key=lambda f: (-f[1], f[0]))[:LEXICON_TERMS])
    bare = Lexicon(chosen)

    def phrases(text: str) -> set[str]:
        folded, out = fold(text), set()
        for start, end, _ in hits(folded, bare):
            while end < len(folded) and folded[end].isalpha():
                end += 1
            after = _WORD.match(folded, end + 1) if folded[end : end + 1] == " " else None
            if after:
                out.add(folded[start : after.end()])
        return out

    def spared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0, SLICE_BYTES):
            found = [(p, t) for x, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for p in phrases(x or "")]
            yield pa.record_batch({"phrase": pa.array([p for p, _ in found], pa.string()), "toxic": pa.array([t for _, t in found], pa.int32())})

    met = rows.mapInArrow(spared, "phrase string, toxic int").groupBy("phrase").agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
    clean_only = met.filter("t = 0 and n >= 3").orderBy(F.desc("n"), "phrase").limit(LEXICON_TERMS).collect()
    lexicon = Lexicon(chosen, tuple(sorted({*[fold(e) for e in exceptions], *[r.phrase for r in clean_only]})))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0, SLICE_BYTES):
            found = [measures(t, lexicon) for t in batch.column(0).to_pylist()]
            yield pa.record_batch({"a": pa.array([a for a, _ in found], pa.float64()), "b": pa.array([b for _, b in found], pa.float64()), "toxic": batch.column(1)})

    points = rows.mapInArrow(measured, "a double, b double, toxic int").collect()
    # As many as the sample has, in one order, so that sums come out alike.
    values = np.array(sorted((r.a, r.b, r.toxic) for r in points))
    lexicon.curve = _fit_curve(values[:, :2], values[:, 2])
    return lexicon


def rate(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score for every row of `docs`."""
    docs = only(docs, doc_id=id_col, text=text_col)
    kind = dict(docs.dtypes)["doc_id"]

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, SLICE_BYTES):
            yield pa.record_batch({"doc_id": batch.column(0), "score": pa.array([score(t, lexicon) for t in batch.column(1).to_pylist()], pa.float64())})

    return docs.mapInArrow(rated, f"doc_id {kind}, score double")
