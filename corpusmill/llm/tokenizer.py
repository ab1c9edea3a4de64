"""Encoding of a corpus with a public byte-level BPE vocabulary.

Pre-tokenisation is vectorised over whole Arrow batches. The texts of a batch become one code-point array; a class array
(letter, number, blank, other, and apostrophes that open a contraction) stands for the pattern of the vocabulary, and a
small automaton over these classes marks where pieces start. An automaton step is a function from states to states, and
composing such functions is associative: blocks are composed independently of each other, then the block functions are
chained, then each block is replayed from its entry state. No regular expression is run.

The slices between two starts are merged pair by pair in order of rank, once per different piece: results are cached.
"""

from __future__ import annotations

import base64
import heapq
import os
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: Where the vocabulary files are; a parameter of every function that needs them.
DEFAULT_DIR = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")
DEFAULT_FILE = "byte_bpe_50k.tiktoken"

# Classes of characters as the automaton sees them.
L, N, O, A2, A3, IN, SP, SX = range(8)
# States after a character: nothing open, in letters, in numbers, in other signs, after a space that joins the next
# piece, within blanks, and within a contraction with one or two letters to go.
START, LETTERS, NUMBERS, OTHERS, JOIN, BLANKS, LEFT1, LEFT2 = range(8)
_BLOCK = 256


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """next[class, state] and starts[class, state] (whether the character starts a piece)."""
    nxt, new = np.zeros((8, 8), np.uint8), np.ones((8, 8), bool)
    for cls, own in ((L, LETTERS), (N, NUMBERS), (O, OTHERS)):
        nxt[cls, :] = own
        new[cls, [own, JOIN]] = False
    for cls, left in ((A2, LEFT1), (A3, LEFT2)):
        nxt[cls, :] = left
        # within other signs or after a joining space it is one of these signs
        nxt[cls, [OTHERS, JOIN]] = OTHERS
        new[cls, [OTHERS, JOIN]] = False
    for cls in range(8):
        nxt[cls, LEFT2], nxt[cls, LEFT1] = LEFT1, START
        new[cls, [LEFT1, LEFT2]] = False
    # all blanks of a run but the last make one piece, unless the text ends with the run
    nxt[IN, [s for s in range(8) if s not in (LEFT1, LEFT2)]] = BLANKS
    new[IN, BLANKS] = False
    nxt[SP, [s for s in range(8) if s not in (LEFT1, LEFT2)]] = JOIN
    nxt[SX, [s for s in range(8) if s not in (LEFT1, LEFT2)]] = START
    return nxt, new


_NEXT, _NEW = _automaton()

#: The blanks of the pattern's \\s.
_BLANK = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(maxsize=1)
def _class_table() -> np.ndarray:
    """L, N, O or IN (any blank) of every code point, by general category."""
    t = np.full(sys.maxunicode + 1, O, np.uint8)
    for cp in range(sys.maxunicode + 1):
        first = unicodedata.category(chr(cp))[0]
        if first in "LN":
            t[cp] = L if first == "L" else N
    t[_BLANK] = IN
    return t


def _classes(cp: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Class of each character; first marks the characters that open a text."""
    cls = _class_table()[cp]
    n = len(cp)
    after = np.full(n + 2, 0, np.uint32)  # following characters, 0 beyond the end of a text
    after[:n] = cp
    ends = np.append(first[1:], True)
    one = np.where(ends, 0, after[1 : n + 1])
    two = np.where(ends | np.append(ends[1:], True), 0, after[2 : n + 2])
    blank = cls == IN
    # a blank is the last of its run if a character that isn't blank follows in the same text
    last = blank & ~ends & ~np.append(blank[1:], False)
    cls[last & (cp == 0x20)] = SP
    cls[last & (cp != 0x20)] = SX
    quote = cp == 0x27
    if quote.any():
        short = np.isin(one, np.frombuffer("stmd".encode("utf-32-le"), np.uint32))
        pairs = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        cls[quote & pairs] = A3
        cls[quote & short] = A2
    return cls


def piece_starts(cp: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Boolean array: the characters that start a piece. cp: code points of texts put together, first: their openings."""
    n = len(cp)
    if n == 0:
        return np.zeros(0, bool)
    cls = _classes(cp, first)
    # the opening of a text forgets the state: its function is constant
    step = np.concatenate([_NEXT, np.repeat(_NEXT[:, START : START + 1], 8, axis=1)])
    sym = cls.astype(np.intp) + 8 * first
    blocks = -(-n // _BLOCK)
    padded = np.zeros(blocks * _BLOCK, np.intp)
    padded[:n] = sym
    grid = padded.reshape(blocks, _BLOCK)
    flat = step.ravel()
    composed = np.tile(np.arange(8, dtype=np.intp), (blocks, 1))
    for j in range(_BLOCK):
        composed = flat[grid[:, j, None] * 8 + composed].astype(np.intp)
    entry = np.zeros(blocks, np.intp)
    state = START
    for b in range(blocks):
        entry[b] = state
        state = composed[b, state]
    before = np.empty((blocks, _BLOCK), np.uint8)
    for j in range(_BLOCK):
        before[:, j] = entry
        entry = flat[grid[:, j] * 8 + entry].astype(np.intp)
    return _NEW[cls, before.ravel()[:n]] | first


class Merger:
    """Ids of pieces by pair merging in order of rank, with a cache of bounded size."""

    def __init__(self, ranks: dict[bytes, int], cache_size: int = 200_000):
        self.ranks, self.cache, self.cache_size = ranks, {}, cache_size

    def __call__(self, piece: str) -> tuple[int, ...]:
        found = self.cache.get(piece)
        if found is None:
            if len(self.cache) >= self.cache_size:
                self.cache.clear()
            found = self.merge(piece.encode("utf-8", "surrogatepass"))
            if len(piece) <= 64:
                self.cache[piece] = found
        return found

    def merge(self, raw: bytes) -> tuple[int, ...]:
        """A linked list of parts and a heap of pairs: n log n, however long the piece."""
        ranks = self.ranks
        whole = ranks.get(raw)
        if whole is not None:
            return (whole,)
        parts: list[bytes | None] = [raw[i : i + 1] for i in range(len(raw))]
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap = [(r, i, 2) for i in range(len(parts) - 1) if (r := ranks.get(raw[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else len(parts)
            if j >= len(parts) or len(parts[i]) + len(parts[j]) != size:
                continue  # one of the two was merged with another part meanwhile
            parts[i] += parts[j]
            parts[j] = None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < len(parts) and (r := ranks.get(parts[a] + parts[b])) is not None:
                    heapq.heappush(heap, (r, a, len(parts[a]) + len(parts[b])))
        return tuple(ranks[p] for p in parts if p is not None)


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    """One per Python worker."""
    return Merger(load_ranks(path))


def pieces(texts: list[str | None]) -> list[tuple[str, list[int]]]:
    """Of each text the text itself and the offsets (in code points) where its pieces start, with its length at the end."""
    real = [t or "" for t in texts]
    lengths = np.array([len(t) for t in real], np.int64)
    cp = np.frombuffer("".join(real).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    first = np.zeros(len(cp), bool)
    first[begins[lengths > 0]] = True
    at = np.flatnonzero(piece_starts(cp, first))
    cut = np.searchsorted(at, np.append(begins, len(cp)))
    return [(t, [*(at[cut[i] : cut[i + 1]] - begins[i]).tolist(), len(t)]) for i, t in enumerate(real)]


def encode_batch(texts: list[str | None], path: str) -> list[list[int]]:
    merge = merger(path)
    get = merge.cache.get
    out = []
    for text, at in pieces(texts):
        ids: list[int] = []
        for a, b in zip(at, at[1:]):
            piece = text[a:b]
            ids.extend(get(piece) or merge(piece))
        out.append(ids)
    return out


def _chunks(texts: list[str | None], most: int = 1_000_000) -> Iterator[slice]:
    """Slices of at most so many characters, at least one text each."""
    begin = size = 0
    for i, t in enumerate(texts):
        if i > begin and size + len(t or "") > most:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(t or "")
    if begin < len(texts):
        yield slice(begin, len(texts))


def encode(df: DataFrame, *, key: str = "doc_id", text: str = "text", tokenizer_dir: str = DEFAULT_DIR, tokenizer_file: str = DEFAULT_FILE, offsets: bool = False) -> DataFrame:
    """key and ids, the token ids of each text without special tokens; with offsets also piece_starts and piece_tokens.

    piece_starts are the offsets (in code points) of the pieces between which no merge is made, piece_tokens the number of
    ids of each, so that any id can be led back to its place. Null and empty texts get an empty list; strings of special
    tokens are ordinary text. One row out per row in, repeated keys included; nothing is shuffled.
    """
    path = f"{tokenizer_dir}/{tokenizer_file}"
    kind = dict(df.select(key).dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        merge = merger(path)
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch["_text"]]
            for part in _chunks(texts):
                out = {key: batch["_key"].iloc[part]}
                if offsets:
                    cut = pieces(texts[part])
                    tokens = [[merge(t[a:b]) for a, b in zip(at, at[1:])] for t, at in cut]
                    out["ids"] = [[i for p in ps for i in p] for ps in tokens]
                    out["piece_starts"] = [at[:-1] for _, at in cut]
                    out["piece_tokens"] = [[len(p) for p in ps] for ps in tokens]
                else:
                    out["ids"] = encode_batch(texts[part], path)
                yield pd.DataFrame(out)

    schema = f"`{key}` {kind}, ids array<int>" + (", piece_starts array<int>, piece_tokens array<int>" if offsets else "")
    return df.select(df[key].alias("_key"), df[text].alias("_text")).mapInPandas(run, schema)


def token_counts(df: DataFrame, *, key: str = "doc_id", text: str = "text", tokenizer_dir: str = DEFAULT_DIR, tokenizer_file: str = DEFAULT_FILE) -> DataFrame:
    """key and n_tokens (bigint) of each text, without sending the ids back."""
    path = f"{tokenizer_dir}/{tokenizer_file}"
    kind = dict(df.select(key).dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        merge = merger(path)
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch["_text"]]
            for part in _chunks(texts):
                counts = [sum(len(merge(t[a:b])) for a, b in zip(at, at[1:])) for t, at in pieces(texts[part])]
                yield pd.DataFrame({key: batch["_key"].iloc[part], "n_tokens": counts})

    return df.select(df[key].alias("_key"), df[text].alias("_text")).mapInPandas(run, f"`{key}` {kind}, n_tokens bigint")


def decode(ids: list[int], *, tokenizer_dir: str = DEFAULT_DIR, tokenizer_file: str = DEFAULT_FILE) -> str:
    """The text of a list of ids."""
    return b"".join(_bytes_of(f"{tokenizer_dir}/{tokenizer_file}")[i] for i in ids).decode("utf-8", "surrogatepass")


def decoded(df: DataFrame, *, key: str = "doc_id", ids: str = "ids", tokenizer_dir: str = DEFAULT_DIR, tokenizer_file: str = DEFAULT_FILE) -> DataFrame:
    """key and text of lists of ids."""
    kind = dict(df.select(key).dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({key: batch[key], "text": [decode(list(x), tokenizer_dir=tokenizer_dir, tokenizer_file=tokenizer_file) for x in batch[ids]]})

    return df.select(key, ids).mapInPandas(run, f"`{key}` {kind}, text string")


@lru_cache(maxsize=2)
def _bytes_of(path: str) -> list[bytes]:
    ranks = load_ranks(path)
    out = [b""] * (max(ranks.values()) + 1)
    for b, i in ranks.items():
        out[i] = b
    return out
