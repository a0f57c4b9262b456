"""Byte-pair ids for all words of a batch at once, from a public tokenizer's own file.

The `tokenizers` library spends most of its time on single words. Here the distinct words of a
batch are merged side by side: in each round every word applies its best pair, the leftmost
of equals, which is the order in which the library applies them. Words of plain letters go
this way, with the run of ASCII signs behind them, which is a piece of its own; every other word,
and every text that spells out a special token, is given to the library itself. Tests hold
the ids against the library's.

It fits word_bpe_49k.json and files of its kind: pieces never cross a blank, case is dropped,
and the last piece of a word is marked.
"""

import json
import os

import numpy as np
import pyarrow as pa

from levyscan.llm.shingles import _bytes_of, distinct_words, find_words

MEMO_WORDS = 100_000
_NONE = np.int32(2**31 - 1)
_SIGN = np.array([33 <= b < 127 and not chr(b).isalnum() for b in range(256)])


class BytePairs:
    """The merge table of a tokenizer file as sorted arrays."""

    def __init__(self, model: dict, end: str):
        vocab = model["vocab"]
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in visible]
        signs = {**{b: chr(b) for b in visible}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}
        self.inner = np.array([vocab[signs[b]] for b in range(256)], dtype=np.int64)
        self.last = np.array([vocab[signs[b] + end] for b in range(256)], dtype=np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.rank = order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)[order]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def encode(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that stand one behind the other in `data`, and how many each has."""
        n = len(sizes)
        ends = np.cumsum(sizes)
        symbols = self.inner[data]
        symbols[ends - 1] = self.last[data[ends - 1]]
        word = np.repeat(np.arange(n), sizes)
        counts = np.zeros(n, np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        merge = np.full(len(symbols), -1, np.int64)
        merge[:-1] = self._ranks(symbols[:-1], symbols[1:])
        merge[ends - 1] = -1
        while len(symbols):
            rank = np.where(merge >= 0, self.rank[merge], _NONE)
            begins = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat(rank, begins)
            lengths = np.diff(begins, append=len(word))
            open_word = best != _NONE
            if not open_word.all():
                keep = np.repeat(open_word, lengths)
                done.append((word[~keep], symbols[~keep]))
                symbols, word, merge, rank = symbols[keep], word[keep], merge[keep], rank[keep]
                best, lengths = best[open_word], lengths[open_word]
                if not len(symbols):
                    break
            hits = np.flatnonzero(rank == np.repeat(best, lengths))
            at = hits[np.diff(word[hits], prepend=-1) != 0]
            symbols[at] = self.made[merge[at]]
            left = np.ones(len(symbols), dtype=bool)
            left[at + 1] = False
            at -= np.arange(len(at))  # places after the right halves are gone
            symbols, word, merge = symbols[left], word[left], merge[left]
            touched = np.concatenate([at, at[at > 0] - 1])
            same = touched < len(word) - 1
            same[same] = word[touched[same]] == word[touched[same] + 1]
            merge[touched[~same]] = -1
            inside = touched[same]
            merge[inside] = self._ranks(symbols[inside], symbols[inside + 1])
        words = np.concatenate([w for w, _ in done])
        ids = np.concatenate([s for _, s in done])
        order = np.argsort(words, kind="stable")
        counts = np.bincount(words, minlength=n)
        return ids[order].astype("<u4"), counts


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each span, one behind the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


class WordTokenizer:
    """Ids of whole texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self._pairs = BytePairs(model, model["end_of_word_suffix"])
        self._tokenizer = Tokenizer.from_file(path)
        self._specials = [t.content.encode() for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._memo: dict[bytes, np.ndarray] = {}

    def whole(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _odd(self, word: bytes) -> np.ndarray:
        found = self._memo.get(word)
        if found is None:
            if len(self._memo) >= MEMO_WORDS:
                self._memo.clear()
            found = self._memo[word] = self.whole(word.decode())
        return found

    @staticmethod
    def _add(parts: list, counts: np.ndarray, words: np.ndarray, ids: np.ndarray, own) -> None:
        """Put ids behind those that the words have already."""
        own = np.broadcast_to(own, words.shape)
        counts[words] += own
        parts.append((np.repeat(words, own), ids))

    def _distinct(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these words one behind the other, and how many each has."""
        n = len(starts)
        spelled = low[_spans(starts, ends - starts)]
        begins = np.cumsum(ends - starts) - (ends - starts)
        last = np.maximum.reduceat(np.where(_SIGN[spelled], -1, np.arange(len(spelled))), begins)
        core_ends = np.where(last >= 0, starts + last + 1 - begins, ends)  # signs alone: an odd word
        sizes = core_ends - starts
        data = low[_spans(starts, sizes)]
        # a-z, and the two-byte letters from U+00C0 to U+00FF in lower case.
        lead = data == 0xC3
        second = np.zeros(len(data), dtype=bool)
        second[1:] = lead[:-1]
        upper = second & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
        data[upper] += 0x20
        plain_byte = ((data >= 97) & (data <= 122) & ~second) | (lead & ~second) | (second & (data >= 0x9F) & (data <= 0xBF) & (data != 0xB7))
        first = np.cumsum(sizes) - sizes
        plain = np.logical_and.reduceat(plain_byte, first)
        chosen = np.repeat(plain, sizes)
        counts = np.zeros(n, np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        if plain.any():
            ids, own = self._pairs.encode(data[chosen], sizes[plain])
            counts[plain] = own
            parts.append((np.repeat(np.flatnonzero(plain), own), ids))
            stopped = np.flatnonzero(plain & (core_ends < ends))
            one = core_ends[stopped] + 1 == ends[stopped]
            for mark in np.unique(low[core_ends[stopped[one]]]).tolist():
                with_mark = stopped[one][low[core_ends[stopped[one]]] == mark]
                self._add(parts, counts, with_mark, np.tile(stop := self._odd(bytes([mark])), len(with_mark)), len(stop))
            if not one.all():
                more = stopped[~one]
                text = low.tobytes()
                runs = [self._odd(text[a:b]) for a, b in zip(core_ends[more].tolist(), ends[more].tolist())]
                self._add(parts, counts, more, np.concatenate(runs), np.array([len(r) for r in runs]))
        odd = np.flatnonzero(~plain)
        if len(odd):
            text = low.tobytes()
            found = [self._odd(text[a:b]) for a, b in zip(starts[odd].tolist(), ends[odd].tolist())]
            counts[odd] = [len(f) for f in found]
            parts.append((np.repeat(odd, counts[odd]), np.concatenate(found)))
        words = np.concatenate([w for w, _ in parts])
        order = np.argsort(words, kind="stable")
        return np.concatenate([i for _, i in parts])[order].astype("<u4"), counts

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; a null has none."""
        low, starts, ends, counts = find_words(texts)
        if not len(starts):
            return [np.empty(0, "<u4")] * len(texts)
        first, place = distinct_words(low, starts, ends)
        ids, sizes = self._distinct(low, starts[first], ends[first])
        of_word = sizes[place]
        flat = ids[_spans((np.cumsum(sizes) - sizes)[place], of_word)]
        bounds = np.concatenate([[0], np.cumsum(of_word)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        out = [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        for i, text in self._spelled_out(texts):
            out[i] = self.whole(text)
        return out

    def _spelled_out(self, texts: pa.Array) -> list[tuple[int, str]]:
        data = _bytes_of(texts)[0].tobytes()
        if not any(s in data for s in self._specials):
            return []
        return [(i, t) for i, t in enumerate(texts.to_pylist()) if t and any(s in t.encode() for s in self._specials)]


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer_for(path: str) -> WordTokenizer:
    """One tokenizer for all tasks of a Python worker."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def default_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
