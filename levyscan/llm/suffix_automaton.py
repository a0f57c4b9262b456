"""Benchmark decontamination with a generalised suffix automaton.

The words of all test items go into one automaton that accepts every run of words of every
item. Training texts stream through it word by word; at each word the automaton holds the
longest run that ends there and stands in some item. Where that run has `window` words or
more (or is a whole shorter item), its words are a leak. Leaks are reported as spans with
the items they come from, or taken out of the texts; a text that is mostly leak goes.

Items are cut into blocks of bounded size, each with an automaton of its own that is built in
a task. A benchmark of usual size is one block; a larger one makes the texts pass through one
automaton after the other, in one stage and without a shuffle. Only the automaton of a block
(bounded by `BLOCK_WORDS`) goes to all tasks. Items too long for a block are cut into parts
that overlap by a window less a word, which loses no window.

Most words of a text cannot begin a leak, so they are passed over first: a table of bits
tells which pairs of neighbouring words occur in no item. It may let a pair through in error
but never drops one; the automaton compares the words themselves.

A word is a maximal run of 0-9, A-Z, a-z (lower-cased) and characters from U+0080 on.

Defined results: a null or empty text has no words and no leak; a null or empty item has no
window; items with one id count as one item; a null item id counts and is shown as an empty
text; repeated rows and repeated ids of texts are rows of their own; an empty benchmark finds
nothing; an empty table gives an empty table; other columns pass through `remove_leaks`
unchanged and are not read elsewhere.
"""

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from levyscan.llm.common import only, slices, stage

WINDOW = 10
BLOCK_WORDS = 200_000  # of one automaton
PART_WORDS = 20_000  # of one part of an item
SLICE_BYTES = 1 << 19
_BITS = 22

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_FIRST = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)
_REST = np.array([8 * (8 - n) for n in range(9)], dtype=np.uint64)
_REST[0] = 63


class Words:
    """The words of a few texts: their bytes in lower case, and where each word lies."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
        self.text_at = at - at[0]
        n = len(raw)
        self._padded = np.zeros(n + 16, dtype=np.uint8)
        self.low = self._padded[8 : 8 + n]
        np.take(_LOWER, raw, out=self.low)
        inside = _WORD[raw]
        edge = np.zeros(n + 1, dtype=bool)
        edge[self.text_at] = True
        before = np.zeros(n, dtype=bool)
        before[1:] = inside[:-1]
        after = np.zeros(n, dtype=bool)
        after[:-1] = inside[1:]
        self.starts = np.flatnonzero(inside & (~before | edge[:n]))
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first_word = np.searchsorted(self.starts, self.text_at)  # of each text, and the end

    def signatures(self) -> np.ndarray:
        """A number for each word from its length, first and last eight bytes."""
        eight = np.ndarray((len(self.low) + 9,), dtype="<u8", buffer=self._padded, strides=(1,))
        size = self.ends - self.starts
        few = np.minimum(size, 8)
        first = eight[self.starts + 8] & _FIRST[few]
        last = eight[self.ends] >> _REST[few]
        mixed = (first * np.uint64(0x9E3779B97F4A7C15)) ^ (last * np.uint64(0xD6E8FEB86659FD93)) ^ (size.astype(np.uint64) << np.uint64(40))
        return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)

    def bytes_of(self, first: int, last: int) -> list[bytes]:
        low, starts, ends = self.low, self.starts[first:last].tolist(), self.ends[first:last].tolist()
        whole = low[starts[0] : ends[-1]].tobytes()
        return [whole[a - starts[0] : b - starts[0]] for a, b in zip(starts, ends)]


def _pair_places(signatures: np.ndarray) -> np.ndarray:
    pairs = signatures[:-1] * np.uint64(0x94D049BB133111EB) + signatures[1:]
    return ((pairs ^ (pairs >> np.uint64(31))) >> np.uint64(64 - _BITS)).astype(np.int64)


def _word_places(signatures: np.ndarray) -> np.ndarray:
    return (signatures >> np.uint64(64 - _BITS)).astype(np.int64)


class Automaton:
    """Suffix automaton of several sequences of word numbers. State 0 is the empty run."""

    def __init__(self):
        self.go: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, go: dict) -> int:
        self.go.append(go)
        self.link.append(link)
        self.length.append(length)
        return len(self.go) - 1

    def _split(self, above: int, word: int, state: int) -> int:
        """The state for the shorter runs of `state` that `above` reaches by `word`."""
        shorter = self._state(self.length[above] + 1, self.link[state], dict(self.go[state]))
        self.link[state] = shorter
        while above >= 0 and self.go[above].get(word) == state:
            self.go[above][word] = shorter
            above = self.link[above]
        return shorter

    def _extend(self, last: int, word: int) -> int:
        known = self.go[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        new = self._state(self.length[last] + 1, 0, {})
        above = last
        while above >= 0 and word not in self.go[above]:
            self.go[above][word] = new
            above = self.link[above]
        if above >= 0:
            met = self.go[above][word]
            self.link[new] = met if self.length[met] == self.length[above] + 1 else self._split(above, word, met)
        return new

    def add(self, words: list[int]) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word)


def build_block(items: list[tuple], window: int) -> bytes:
    """The automaton of a block of items (id, words as bytes), with what matching needs:
    for each state the state of its last `window` words (-1 if it has fewer), the items of
    those states, the whole items shorter than a window, and the bits of word pairs."""
    number: dict[bytes, int] = {}
    ids: dict = {}
    sequences = [(ids.setdefault(item, len(ids)), [number.setdefault(w, len(number)) for w in words]) for item, words in items if words]
    automaton = Automaton()
    for _, sequence in sequences:
        automaton.add(sequence)
    go, link, length = automaton.go, automaton.link, automaton.length
    ends = [-1] * len(go)
    for state in sorted(range(1, len(go)), key=length.__getitem__):
        if length[state] >= window:
            ends[state] = ends[link[state]] if length[link[state]] >= window else state
    owners: dict[int, set[int]] = {}
    whole: dict[int, set[int]] = {}
    for item, sequence in sequences:
        state = 0
        for i, word in enumerate(sequence):
            state = go[state][word]
            if i + 1 >= window:
                state = ends[state]
                owners.setdefault(state, set()).add(item)
        if len(sequence) < window:
            whole.setdefault(state, set()).add(item)
    below = [-1] * len(go)  # the state itself or the longest shorter run that is a whole item
    if whole:
        for state in sorted(range(1, len(go)), key=length.__getitem__):
            below[state] = state if state in whole else below[link[state]]
    words = Words(pa.array([b" ".join(w) for _, w in items], pa.large_binary()))
    signatures = words.signatures()
    pairs = _pair_places(signatures) if len(signatures) > 1 else np.empty(0, np.int64)
    inner = np.ones(len(pairs), dtype=bool)
    cut = words.first_word[1:-1] - 1
    inner[cut[(cut >= 0) & (cut < len(pairs))]] = False
    width = len(number)
    return pickle.dumps(
        {
            "number": number,
            "ids": list(ids),
            "width": width,
            "go": {state * width + word: to for state, out in enumerate(go) for word, to in out.items()},
            "link": link,
            "length": length,
            "ends": ends,
            "owners": {s: sorted(o) for s, o in owners.items()},
            "whole": {s: sorted(o) for s, o in whole.items()},
            "below": below if whole else None,
            "least": min((min(len(s), window) for _, s in sequences), default=window),
            "pairs": np.unique(pairs[inner]),
            "words": np.unique(_word_places(signatures)),
            "window": window,
        }
    )


class Matcher:
    """Finds leaks in texts with the automaton of one block."""

    def __init__(self, block: bytes):
        self.__dict__.update(pickle.loads(block))
        self.bits = np.zeros(1 << _BITS, dtype=bool)
        self.bits[self.pairs if self.least > 1 else self.words] = True

    def _runs(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """First and last-plus-one words of the stretches that can hold a leak."""
        signatures = words.signatures()
        if self.least > 1:
            if len(signatures) < 2:
                return np.empty(0, np.int64), np.empty(0, np.int64)
            near = self.bits[_pair_places(signatures)]
            cut = words.first_word[1:-1] - 1
            near[cut[(cut >= 0) & (cut < len(near))]] = False
        else:
            near = self.bits[_word_places(signatures)]
        change = np.diff(np.concatenate([[False], near, [False]]).astype(np.int8))
        first, last = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        if self.least > 1:
            last = last + 1
        else:  # stretches of single words go on from text to text
            cuts = words.first_word[1:-1]
            first, last = _cut_at(first, last, cuts[(cuts > 0) & (cuts < len(near))])
        long = last - first >= self.least
        return first[long], last[long]

    def spans(self, run: list[bytes]) -> tuple[list[list[int]], set[int]]:
        """[first word, last word + 1, longest match] of the leaks in a stretch, and the items."""
        go, link, length, width, ends, window, below = self.go, self.link, self.length, self.width, self.ends, self.window, self.below
        found: list[list[int]] = []
        items: set[int] = set()
        met: set[int] = set()
        state = size = 0

        def leak(first: int, end: int, longest: int):
            while found and first <= found[-1][1] and first < found[-1][0]:
                longest = max(longest, found.pop()[2])
            if found and first < found[-1][1]:
                found[-1][1], found[-1][2] = end, max(found[-1][2], longest)
            else:
                found.append([first, end, longest])

        for i, word in enumerate(map(self.number.get, run)):
            if word is None:
                state = size = 0
                continue
            to = go.get(state * width + word)
            while to is None and state:
                state = link[state]
                size = length[state]
                to = go.get(state * width + word)
            if to is None:
                size = 0
                continue
            state, size = to, size + 1
            if size >= window:
                leak(i + 1 - window, i + 1, size)
                met.add(ends[state])
            if below is not None:
                whole = below[state]
                if whole >= 0 and length[whole] > size:
                    whole = below[link[whole]]
                while whole >= 0:
                    leak(i + 1 - length[whole], i + 1, length[whole])
                    items.update(self.whole[whole])
                    whole = below[link[whole]]
        for end in met:
            items.update(self.owners[end])
        return found, items

    def match(self, texts: pa.Array) -> tuple[np.ndarray, dict[int, tuple[list, list]]]:
        """Words of each text; and for texts with leaks their spans [first word, last word + 1,
        longest match, first character, last character + 1] and item ids."""
        words = Words(texts)
        out: dict[int, tuple[list, list]] = {}
        places: dict[int, np.ndarray] = {}
        for first, last in zip(*[a.tolist() for a in self._runs(words)]):
            found, items = self.spans(words.bytes_of(first, last))
            if not found:
                continue
            text = int(np.searchsorted(words.first_word, first, "right")) - 1
            base = int(words.text_at[text])
            if text not in places:
                low = words.low[base : words.text_at[text + 1]]
                places[text] = np.cumsum((low & 0xC0) != 0x80)  # characters up to and with a byte
            spans, ids = out.setdefault(text, ([], []))
            for a, b, longest in found:
                start, end = int(words.starts[first + a]) - base, int(words.ends[first + b - 1]) - base
                of_text = int(words.first_word[text])
                spans.append([first + a - of_text, first + b - of_text, longest, int(places[text][start]) - 1, int(places[text][end - 1])])
            known = set(ids)
            ids.extend(i for i in (self.ids[k] for k in sorted(items)) if i not in known)
        return np.diff(words.first_word), out


def _cut_at(first: np.ndarray, last: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches cut at the given places that lie inside them."""
    at = np.searchsorted(first, cuts, "left") - 1
    inside = cuts[(at >= 0) & (cuts < last[np.maximum(at, 0)])] if len(first) else cuts[:0]
    return np.sort(np.concatenate([first, inside])), np.sort(np.concatenate([last, inside]))


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> list[bytes]:
    """The automata of all items, each of about `block_words` words."""
    items = only(benchmark, item_id=id_col, text=text_col)
    kind = dict(items.dtypes)["item_id"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, SLICE_BYTES):
            words = Words(batch.column(1))
            place, parts, sizes = [], [], []
            for i, (first, last) in enumerate(zip(words.first_word[:-1].tolist(), words.first_word[1:].tolist())):
                for a in range(first, last, PART_WORDS):
                    part = words.bytes_of(a, min(a + PART_WORDS + window - 1, last))
                    if a == first or len(part) >= window:
                        place.append(i)
                        parts.append(b" ".join(part))
                        sizes.append(len(part))
            yield pa.record_batch(
                {"item_id": batch.column(0).take(pa.array(place, pa.int64())), "words": pa.array(parts, pa.binary()), "size": pa.array(sizes, pa.int64())}
            )

    parts = stage(items.mapInArrow(cut, f"item_id {kind}, words binary, size long").distinct(), "items")
    total = parts.agg(F.sum("size")).first()[0] or 0
    if not total:
        return []
    count = -(-total // block_words)

    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = zip(table.column("item_id").to_pylist(), table.column("words").to_pylist())
        return pa.table({"block": [build_block([(i, w.split(b" ")) for i, w in rows], window)]})

    dealt = parts.withColumn("at", F.pmod(F.xxhash64("item_id", "words"), F.lit(count)))
    built = stage(dealt.groupBy("at").applyInArrow(build, "block binary").withColumn("nth", F.monotonically_increasing_id()), "automata")
    keys = sorted(r.nth for r in built.select("nth").collect())
    return [bytes(built.filter(F.col("nth") == k).first().block) for k in keys]


_SPAN = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("longest", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
_SPANS = "array<struct<first:int,last:int,longest:int,start:int,end:int>>"


def _joined(one: list, two: list) -> list:
    """Two lists of spans as one: overlapping spans become one."""
    out: list = []
    for span in sorted([*one, *two]):
        if out and span[0] < out[-1][1]:
            longest, top = max(out[-1][2], span[2]), max(out[-1], span, key=lambda s: s[1])
            out[-1] = [out[-1][0], top[1], longest, out[-1][3], top[4]]
        else:
            out.append(list(span))
    return out


def _with_leaks(docs: DataFrame, text_col: str, item_type: str, built: list[bytes], window: int) -> DataFrame:
    """`docs` with __words, __spans and __items."""
    place = docs.columns.index(text_col)
    wanted = StructType.fromDDL(f"__words long, __spans {_SPANS}, __items array<{item_type}>")
    schema = StructType([*docs.schema.fields, *wanted.fields])

    def passed(block: bytes, first: bool):
        def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block)
            for batch in slices(batches, place, SLICE_BYTES):
                sizes, found = matcher.match(batch.column(place))
                spans, items = [()] * batch.num_rows, [()] * batch.num_rows
                if not first:
                    spans = [[list(s.values()) for s in row] for row in batch.column("__spans").to_pylist()]
                    items = batch.column("__items").to_pylist()
                    batch = batch.select(batch.schema.names[:-3])
                for i, (more, ids) in found.items():
                    spans[i] = _joined(spans[i], more)
                    items[i] = [*items[i], *[x for x in ids if x not in set(items[i])]]
                keys = _SPAN.names
                rows = pa.array([[dict(zip(keys, s)) for s in row] for row in spans], pa.list_(_SPAN))
                kind = pa.list_(_arrow_type(item_type))
                columns = [*batch.columns, pa.array(sizes, pa.int64()), rows, pa.array(items, kind)]
                yield pa.record_batch(columns, names=[*batch.schema.names, "__words", "__spans", "__items"])

        return match

    out = docs
    for i, block in enumerate(built or [build_block([], window)]):
        out = out.mapInArrow(passed(block, i == 0), schema)
    return out


def _arrow_type(name: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "smallint": pa.int16()}[name]


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """(doc_id, n_words, spans, items) for each row of `docs`. Spans are disjoint and in order:
    words [first, last), characters [start, end), and the longest run of one item in it.
    `items` are the ids of all items with a window in the text, in no order."""
    built = blocks(benchmark, window=window, block_words=block_words)
    found = _with_leaks(only(docs, doc_id=id_col, text=text_col), "text", dict(benchmark.dtypes)["item_id"], built, window)
    return found.select("doc_id", F.col("__words").alias("n_words"), F.col("__spans").alias("spans"), F.col("__items").alias("items"))


def remove_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    longest: int = WINDOW,
    coverage: float = 0.5,
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """`docs` without leaks, all columns kept: spans whose longest run has `longest` words or
    more are cut out of the texts, and texts of which leaks make up more than `coverage` of
    the words are dropped. Texts without such spans stay as they are, nulls included."""
    built = blocks(benchmark, window=window, block_words=block_words)
    found = _with_leaks(docs, text_col, dict(benchmark.dtypes)["item_id"], built, window)
    words = F.aggregate("__spans", F.lit(0), lambda n, s: n + s["last"] - s["first"])
    kept = found.filter(words <= F.col("__words") * coverage)
    cut = F.filter("__spans", lambda s: s["longest"] >= longest)
    text, spans = F.col(f"`{text_col}`"), F.col("__cut")
    begins = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    stops = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text)))
    pieces = F.transform(F.arrays_zip(begins.alias("b"), stops.alias("e")), lambda z: F.substring(text, z["b"] + 1, z["e"] - z["b"]))
    clean = F.when(F.size(spans) > 0, F.array_join(pieces, "")).otherwise(text)
    return kept.withColumn("__cut", cut).select(*[clean.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
