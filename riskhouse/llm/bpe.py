"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue (operator 7).

The pre-tokens that a block of texts brings for the first time are merged
together: each is a doubly linked list of byte positions, and each adjacent pair
whose joined bytes are a token waits in the bucket of its rank.  A bitmap of
three levels (64 ranks a word, 64 words a word, ...) tells the lowest rank that
waits by find-first-set.  Its bucket's positions are merged from left to right;
a position whose pair has changed meanwhile is stale and is skipped.  The work
for n bytes is O(n log n), however long a single pre-token is.

Edge cases: a null or empty text has no ids and decodes to nothing; repeated
rows give repeated results; other columns pass through untouched (a column of the
output's name is replaced); an empty table gives an empty one.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskhouse.llm import common

#: Pre-tokens and their characters that a worker remembers between blocks (speed only).
REMEMBER, REMEMBER_CHARS = 300_000, 16 << 20
#: Pre-tokens that are merged together.
TOGETHER = 50_000
_NONE = np.int64(1) << 40
_encoders: dict = {}


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a .tiktoken file; its size is that of the vocabulary, whatever the corpus."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class RankQueue:
    """Buckets of list positions by rank; the lowest non-empty rank by find-first-set."""

    def __init__(self, n_ranks: int):
        self.low = [0] * (n_ranks // 64 + 1)
        self.mid = [0] * (len(self.low) // 64 + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, positions: list[int]) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket += positions
            return
        self.buckets[rank] = positions
        i, j = rank >> 6, rank >> 12
        self.low[i] |= 1 << (rank & 63)
        self.mid[j] |= 1 << (i & 63)
        self.top |= 1 << j

    def pop(self) -> tuple[int, list[int]]:
        """The lowest rank that waits and its whole bucket; rank -1 if nothing waits."""
        top = self.top
        if not top:
            return -1, []
        j = (top & -top).bit_length() - 1
        word = self.mid[j]
        i = (j << 6) + (word & -word).bit_length() - 1
        word = self.low[i]
        rank = (i << 6) + (word & -word).bit_length() - 1
        self.low[i] = word & (word - 1)
        if not self.low[i]:
            self.mid[j] &= ~(1 << (i & 63))
            if not self.mid[j]:
                self.top &= ~(1 << j)
        return rank, self.buckets.pop(rank)


class Vocabulary:
    """Ranks, and the pairs of tokens that join to a token as sorted keys."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.n = ranks, max(ranks.values(), default=-1) + 1
        self.byte = np.array([ranks.get(bytes([b]), self.n) for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a * (self.n + 1) + b] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.joined = np.array([pairs[k] for k in self.keys.tolist()], np.int64)

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair's joined bytes, or _NONE."""
        if not len(self.keys):
            return np.full(len(a), _NONE)
        key = a * (self.n + 1) + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.joined[at], _NONE)


def merge(pieces: list[bytes], vocabulary: Vocabulary) -> list[np.ndarray]:
    """Token ids of each pre-token."""
    out: list = [None] * len(pieces)
    rest = []
    for k, piece in enumerate(pieces):
        whole = vocabulary.ranks.get(piece)
        if whole is None:
            rest.append(k)
        else:
            out[k] = np.array([whole], "<u4")
    if not rest:
        return out
    none = vocabulary.n  # stands between two pre-tokens and joins with nothing
    raw = np.frombuffer(b"\0" + b"\0".join(pieces[k] for k in rest) + b"\0", np.uint8)
    sizes = np.array([len(pieces[k]) for k in rest])
    fences = np.concatenate([[0], np.cumsum(sizes + 1)])
    owner = np.repeat(np.arange(len(rest) + 1), np.append(sizes + 1, 1))
    token = vocabulary.byte[raw]
    token[fences] = none
    n = len(token)
    after, back, gone = np.arange(1, n + 1), np.arange(-1, n - 1), np.zeros(n, bool)
    waits = np.append(vocabulary.join(token[:-1], token[1:]), _NONE)
    queue = RankQueue(none + 1)
    first = np.flatnonzero(waits < _NONE)
    first = first[np.argsort(waits[first], kind="stable")]
    for group in np.split(first, np.flatnonzero(np.diff(waits[first])) + 1):
        if len(group):
            queue.push(int(waits[group[0]]), group.tolist())
    while True:
        rank, bucket = queue.pop()
        if rank < 0:
            break
        at = np.array(bucket, np.int64)
        at = at[waits[at] == rank]
        if not len(at):
            continue
        if len(at) > 1:
            at = _apart(np.unique(at), rank, token, after, back, owner, vocabulary, queue)
        right = after[at]
        then = after[right]
        token[at], after[at], back[then] = rank, then, at
        gone[right], waits[right] = True, _NONE
        before = back[at]
        touched = np.concatenate([at, before]) if len(at) == 1 else np.unique(np.concatenate([at, before]))
        found = vocabulary.join(token[touched], token[after[touched]])
        waits[touched] = found
        for r, p in zip(found.tolist(), touched.tolist(), strict=True):
            if r < _NONE:
                queue.push(r, [p])
    gone[fences] = True
    kept, ids = np.flatnonzero(~gone), token.astype("<u4")
    cuts = np.searchsorted(kept, fences)
    for k, lo, hi in zip(rest, cuts[:-1], cuts[1:], strict=True):
        out[k] = ids[kept[lo:hi]]
    return out


def _apart(at, rank, token, after, back, owner, vocabulary, queue):
    """Of the positions that wait for ``rank``, in order: those to merge now, as if leftmost first.

    Of pairs that overlap (a run of one token) every other one counts.  If a
    merge would make a pair of a lower rank, which would come before the next
    pair of this rank in its pre-token, only the leftmost is merged now.
    """
    every = at
    chained = np.append(False, after[at[:-1]] == at[1:])
    if chained.any():
        run = np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
        at = at[(np.arange(len(at)) - run) % 2 == 0]
    many = np.append(False, owner[at[1:]] == owner[at[:-1]])
    if many.any():
        then = after[after[at]]
        joined = np.append(False, after[after[at[:-1]]] == at[1:])
        made = np.full(len(at), rank)
        low = vocabulary.join(made, token[then]) < rank
        low |= vocabulary.join(np.where(joined, rank, token[back[at]]), made) < rank
        if low.any():
            own = owner[at[low]]
            at = at[~(many & np.isin(owner[at], own))]
            # all others of those pre-tokens wait on, also the ones that overlap
            queue.push(rank, every[np.isin(owner[every], own) & ~np.isin(every, at)].tolist())
    return at


def latin_pattern(pattern: str) -> str:
    """The pattern with its Unicode classes written out, for texts below U+0100 and the faster standard library."""
    import regex

    low = [chr(c) for c in range(256)]
    of = {"L": "", "N": "", "s": "".join(c for c in low if regex.match(r"\s", c))}
    for c in low:
        if (kind := unicodedata.category(c)[0]) in "LN":
            of[kind] += c
    of = {k: "".join(f"\\x{ord(c):02x}" for c in v) for k, v in of.items()}
    out = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{of['s']}{of['L']}{of['N']}]")
    for kind in "LN":
        out = out.replace(f"\\p{{{kind}}}", f"[{of[kind]}]")
    return out.replace(r"\s", f"[{of['s']}]").replace(r"\S", f"[^{of['s']}]")


class Encoder:
    """texts -> ids, remembering pre-tokens between blocks; one for each worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.vocabulary, self.find = Vocabulary(ranks), regex.compile(pattern).findall
        latin = latin_pattern(pattern)
        self.find_latin = self.find if "\\p{" in latin else re.compile(latin).findall
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids: list[bytes] = []
        self.chars = 0

    def words(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.find(text)
        return self.find_latin(text)

    def block(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.number) >= REMEMBER or self.chars >= REMEMBER_CHARS:
            self.forget()
        number, rows = self.number, []
        known = len(number)
        for text in texts:
            rows.append(array("I", [number.setdefault(w, len(number)) for w in self.words(text)]))
        fresh = list(number)[known:] if len(number) > known else []
        self.chars += sum(map(len, fresh))
        for k in range(0, len(fresh), TOGETHER):
            self.ids += [x.tobytes() for x in merge([w.encode() for w in fresh[k : k + TOGETHER]], self.vocabulary)]
        return [b"".join(map(self.ids.__getitem__, row)) for row in rows]


def _encoder(ranks: dict[bytes, int], pattern: str) -> Encoder:
    key = (len(ranks), hash(frozenset(ranks.items())), pattern)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(ranks, pattern)
    return _encoders[key]


def decode_ids(ids: bytes, table: np.ndarray, starts: np.ndarray, sizes: np.ndarray, most: int = 1 << 18) -> bytes:
    """Bytes of ids, in steps of ``most`` ids.  table: all tokens' bytes, of which id i has sizes[i] from starts[i]."""
    out, every = [], np.frombuffer(ids, "<u4")
    for at in range(0, len(every), most):
        own = every[at : at + most]
        n = sizes[own]
        ends = np.cumsum(n)
        if len(ends) and ends[-1]:
            out.append(table[np.arange(ends[-1]) + np.repeat(starts[own] - ends + n, n)].tobytes())
    return b"".join(out)


def _with_binary(df: DataFrame, steps: list) -> DataFrame:
    """df with binary columns, made one after the other in one pass over the blocks.

    steps: (column to read, column to add, make); ``make()``, called in each task, gives a
    function from a list of the read column's values to the added one's.
    """
    df = df.drop(*[new for _, new, _ in steps])
    names, first = df.columns, df.columns.index(steps[0][0])

    def run(batches):
        made = [(column, new, make()) for column, new, make in steps]
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(first)), 0).to_numpy(zero_copy_only=False)
            off = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            for lo, hi in common.row_blocks(off):
                part = batch.slice(lo, hi - lo)
                out: dict[str, list] = {}
                for column, new, fn in made:
                    out[new] = fn(out[column] if column in out else part.column(names.index(column)).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(v, pa.binary()) for v in out.values())], names=[*names, *out])

    schema = df.withColumns({new: F.lit(None).cast("binary") for _, new, _ in steps}).schema
    common.ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def _encoding(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str, ids: str):
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    def make():
        own = _encoder(shared.value, pattern)
        return lambda values: own.block([v or "" for v in values])

    return text, ids, make


def _decoding(df: DataFrame, ranks: dict[bytes, int], ids: str, decoded: str):
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    def make():
        tokens = [b""] * (max(shared.value.values(), default=-1) + 1)
        for token, rank in shared.value.items():
            tokens[rank] = token
        sizes = np.array([len(t) for t in tokens], np.int64)
        table, starts = np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(sizes) - sizes
        return lambda values: [decode_ids(v or b"", table, starts, sizes) for v in values]

    return ids, decoded, make


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds ``ids``: the tokens of ``text`` as little-endian unsigned 32-bit integers (binary)."""
    return _with_binary(df, [_encoding(df, ranks, pattern, text, ids)])


def decode(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds ``decoded``: the bytes of ``ids`` (binary)."""
    return _with_binary(df, [_decoding(df, ranks, ids, decoded)])


def round_trip(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds ``ids`` and ``decoded`` in one pass: each block is encoded and its ids decoded."""
    return _with_binary(df, [_encoding(df, ranks, pattern, text, ids), _decoding(df, ranks, ids, decoded)])


def digests(df: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded bytes of every whole text."""
    both = round_trip(df.select("doc_id", "text"), ranks, pattern)
    return both.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def public_vocabulary() -> tuple[dict[bytes, int], str]:
    import public_tokenizers

    return load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


def tokenized(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids (binary) and whether they decode to the text, for every document."""
    ranks, pattern = public_vocabulary()
    both = round_trip(docs.select("doc_id", "text"), ranks, pattern)
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return both.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", (F.col("decoded") == text).alias("round_trip"))


def op7_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return digests(common.documents(spark, sf_dir), *public_vocabulary())
