"""Cross-tokenizer alignment by diagonal run skipping (operator 11).

A text is encoded by two tokenizers, and the byte offsets at which tokens of both end cut its tokens into groups.
Both end arrays ascend, so the walk goes along the diagonal of the present index shift: exponential probing
compares stretches of 1, 2, 4, ... ends of either array at that shift, and one-to-one stretches are jumped as a whole;
where the ends differ, the irregular group is resolved token by token, and the shift changes to where it ends.
One walk covers a block of texts, since both arrays end with every text.

A link is a pair of token occurrences whose byte ranges overlap; how often an id pair is linked is counted over the
whole corpus.  The walk's links per document are written as a table in the shared folder; the counts are summed
per task, then by a shuffle; and the table is read with the counts of the pairs.  Those are broadcast in blocks
of at most PAIRS pairs (whole B ids): their number is bounded by the vocabularies, not by the documents, and one
block is enough for PAIRS pairs, so links are never shuffled and the driver never holds more than a block.

Texts of over PIECE characters are encoded in pieces, cut at a blank between ASCII letters or digits, where neither
tokenizer joins anything (``Pair`` checks the vocabularies); a text without such a blank is encoded as one piece.

Edge cases: null and empty texts, and texts whose joined tokens differ from a blank plus the text, have no tokens: all numbers are 0 and
the digest is ''; repeated rows and ids are documents of their own; an empty table gives an empty result; further columns
take no part, whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskhouse.llm import common
from riskhouse.llm.bpe import decode_ids
from riskhouse.session import scratch_path

#: Id pairs whose counts are broadcast at a time; characters of one encoded piece; bytes of one block of texts.
PAIRS, PIECE, TEXTS = 4_000_000, 1 << 18, 1 << 20
#: Fixed value: the byte-level vocabularies' pattern of pre-tokens.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_CUT = re.compile("(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write a byte as itself if it is printable, else as the next free character from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    free = itertools.count(256)
    return {chr(b if b in plain else next(free)): b for b in range(256)}


class Tokens:
    """Bytes of every token of a vocabulary, by id."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.table = np.frombuffer(b"".join(tokens), np.uint8)
        digits = [b"%d" % k for k in range(len(tokens))]
        self.width = np.array([len(d) for d in digits], np.int64)
        wide = int(self.width.max(initial=1))
        self.digits = np.frombuffer(b"".join(d.ljust(wide) for d in digits), np.uint8).reshape(-1, wide)

    def __len__(self) -> int:
        return len(self.sizes)

    def joined(self, ids: np.ndarray) -> bytes:
        return decode_ids(ids.astype("<u4").tobytes(), self.table, self.starts, self.sizes)


class ByteLevel:
    """A byte-level BPE from its JSON file; special tokens' strings inside a text are plain text."""

    def __init__(self, content: bytes):
        import tiktoken

        model = json.loads(content)["model"]
        letter = _byte_letters()
        # special tokens lie outside the merges; plain text never gives them
        made = {a + b for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])}
        usable = {t: i for t, i in model["vocab"].items() if len(t) == 1 or t in made}
        order = [model["vocab"][a + b] for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        if order != sorted(order):
            raise ValueError("ids do not follow the order of the merges")
        ranks = {bytes(letter[c] for c in t): i for t, i in usable.items()}
        self.encoding = tiktoken.Encoding("left", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        every = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            every[i] = token
        self.tokens, self.cuttable = Tokens(every), True

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(" " + t) for t in texts]


class Pieces:
    """A sentence-piece model, which adds the blank itself."""

    def __init__(self, content: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        raw = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        # no piece goes on over a blank, so a cut in front of one changes nothing
        self.tokens, self.cuttable = Tokens(raw), not any("▁" in p.lstrip("▁") for p in names)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def pieces(text: str, most: int) -> list[str]:
    """The text without the single blanks it is cut at."""
    out, at = [], 0
    while len(text) - at > most:
        cut = _CUT.search(text, at + most)
        if cut is None:
            break
        out.append(text[at : cut.start()])
        at = cut.end()
    return [*out, text[at:]]


def skip_runs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The alignment of two ascending arrays of ends with a common last end.

    Returns the one-to-one runs (rows of i, j, length), the links (i, j) of irregular groups, and those groups' ends (i, j, exclusive).
    """
    left, right = a.astype("<u4").tobytes(), b.astype("<u4").tobytes()
    a_end, b_end = a.tolist(), b.tolist()
    runs, links, closes = [], [], []
    i, j, n, m = 0, 0, len(a_end), len(b_end)
    while i < n:
        if a_end[i] == b_end[j]:
            first, at, step = i, j, 1
            i, j = i + 1, j + 1
            while i + step <= n and j + step <= m and left[4 * i : 4 * (i + step)] == right[4 * j : 4 * (j + step)]:
                i, j, step = i + step, j + step, 2 * step
            while step > 1:  # the first difference lies less than a step ahead
                step >>= 1
                if i + step <= n and j + step <= m and left[4 * i : 4 * (i + step)] == right[4 * j : 4 * (j + step)]:
                    i, j = i + step, j + step
            runs.append((first, at, i - first))
            if i == n:
                break
        while True:
            links.append((i, j))
            x, y = a_end[i], b_end[j]
            if x < y:
                i += 1
            elif y < x:
                j += 1
            else:
                i, j = i + 1, j + 1
                closes.append((i, j))
                break
    return np.array(runs, np.int64).reshape(-1, 3), np.array(links, np.int64).reshape(-1, 2), np.array(closes, np.int64).reshape(-1, 2)


def _cuts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


class Block:
    """The tokens, groups and links of a block of texts: a, b ids; of, row bounds; links and group ends as token indices."""

    def __init__(self, left, right, texts: list[str | None], piece: int = PIECE):
        most = piece if left.cuttable and right.cuttable else 1 << 62
        parts = [pieces(t, most) if t else [] for t in texts]
        flat = list(itertools.chain.from_iterable(parts))
        rows = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
        self.left, self.right, n = left.tokens, right.tokens, len(texts)
        a_ids, b_ids = left.encode(flat), right.encode(flat)
        size_a, size_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (a_ids, b_ids))
        a, b = (np.fromiter(itertools.chain.from_iterable(ids), np.int64) for ids in (a_ids, b_ids))
        in_a, in_b = (np.bincount(rows, size, n).astype(np.int64) for size in (size_a, size_b))
        good = self._whole(a, b, in_a, in_b, texts)
        if not good.all():
            a, b = a[np.repeat(good, in_a)], b[np.repeat(good, in_b)]
            in_a, in_b = in_a * good, in_b * good
        self.a, self.b, self.a_of, self.b_of = a, b, _cuts(in_a), _cuts(in_b)
        runs, links, closes = skip_runs(np.cumsum(self.left.sizes[a]), np.cumsum(self.right.sizes[b]))
        inside = np.arange(runs[:, 2].sum()) - np.repeat(_cuts(runs[:, 2])[:-1], runs[:, 2])
        one_i, one_j = np.repeat(runs[:, 0], runs[:, 2]) + inside, np.repeat(runs[:, 1], runs[:, 2]) + inside
        self.link_a, self.link_b = np.concatenate([one_i, links[:, 0]]), np.concatenate([one_j, links[:, 1]])
        self.group_a = np.sort(np.concatenate([one_i + 1, closes[:, 0]]))
        self.group_b = np.sort(np.concatenate([one_j + 1, closes[:, 1]]))
        self.group_of = np.searchsorted(self.group_a, self.a_of, "right")
        self.n_links = np.bincount(np.searchsorted(self.a_of, self.link_a, "right") - 1, minlength=n) if len(a) else np.zeros(n, np.int64)

    def _whole(self, a, b, in_a, in_b, texts) -> np.ndarray:
        """Whether a row's joined tokens are a blank and its text, on both sides."""
        wanted = [(" " + t).encode() if t else b"" for t in texts]
        sizes = np.array([len(w) for w in wanted], np.int64)
        every, good = b"".join(wanted), np.ones(len(texts), bool)
        for tokens, ids, of in ((self.left, a, _cuts(in_a)), (self.right, b, _cuts(in_b))):
            made, ends = tokens.joined(ids), _cuts(tokens.sizes[ids])[of]
            if made != every or (np.diff(ends) != sizes).any():
                good &= [made[x:y] == w for x, y, w in zip(ends[:-1].tolist(), ends[1:].tolist(), wanted, strict=True)]
        return good

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row bounds, distinct id pairs (a * |B| + b, ascending in a row) and how often the row links them."""
        space = len(self.left) * len(self.right)
        row = np.searchsorted(self.a_of, self.link_a, "right") - 1
        key, times = np.unique(row * space + self.a[self.link_a] * len(self.right) + self.b[self.link_b], return_counts=True)
        return np.searchsorted(key, np.arange(len(self.a_of)) * space), key % space, times

    def group_digests(self) -> list[str]:
        """sha256 of each row's groups, ``a1,a2|b1;a3|b2``; '' without tokens."""
        wide = max(self.left.digits.shape[1], self.right.digits.shape[1])
        total = len(self.a) + len(self.b)
        text, width = np.zeros((total, wide + 1), np.uint8), np.zeros(total, np.int64)
        # a group's A tokens stand before its B tokens
        at_a = np.arange(len(self.a)) + np.concatenate([[0], self.group_b])[np.searchsorted(self.group_a, np.arange(len(self.a)), "right")]
        in_b = np.searchsorted(self.group_b, np.arange(len(self.b)), "right")
        at_b = np.arange(len(self.b)) + self.group_a[in_b] if len(self.b) else np.zeros(0, np.int64)
        mark = np.full(total, ord(","), np.uint8)
        for at, ids, tokens, ends, sign in ((at_a, self.a, self.left, self.group_a, "|"), (at_b, self.b, self.right, self.group_b, ";")):
            text[at, : tokens.digits.shape[1]] = tokens.digits[ids]
            width[at] = tokens.width[ids]
            mark[at[ends - 1]] = ord(sign)
        text[np.arange(total), width] = mark
        flat = text[np.arange(wide + 1) <= width[:, None]].tobytes()
        ends = _cuts(width + 1)[self.a_of + self.b_of].tolist()
        return [hashlib.sha256(flat[x : y - 1]).hexdigest() if y > x else "" for x, y in itertools.pairwise(ends)]


_numbers = itertools.count()
_loaded: dict[int, list] = {}


class Pair:
    """Two tokenizers, sent to the executors as their files' contents and built once in each Python worker."""

    def __init__(self, spark, left: tuple[type, bytes], right: tuple[type, bytes]):
        self.number, self.files = next(_numbers), spark.sparkContext.broadcast((left, right))
        self.sizes = [len(kind(content).tokens) for kind, content in (left, right)]
        #: Type of an id pair, a * |B| + b.
        self.type = "<u4" if self.sizes[0] * self.sizes[1] < 1 << 32 else "<u8"

    def load(self) -> list:
        if self.number not in _loaded:
            _loaded.clear()
            _loaded[self.number] = [kind(content) for kind, content in self.files.value]
        return _loaded[self.number]

    def blocks(self, batches, text: int = 1):
        """Parts of the batches with their aligned texts."""
        for batch in batches:
            _, off = common.utf8(batch.column(text))
            for lo, hi in common.row_blocks(off, TEXTS):
                part = batch.slice(lo, hi - lo)
                yield part, Block(*self.load(), part.column(text).to_pylist())


def public_pair(spark) -> Pair:
    import public_tokenizers

    def content(name: str) -> bytes:
        with open(public_tokenizers.path(name), "rb") as f:
            return f.read()

    return Pair(spark, (ByteLevel, content("byte_bpe_50k.json")), (Pieces, content("piece_bpe_32k.model")))


def _nested(values: np.ndarray, of: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(of, pa.int32()), pa.array(values, pa.int32()))


def align(docs: DataFrame, pair: Pair) -> DataFrame:
    """doc_id, the ids of both sides and the ends of the groups in either (token indices, exclusive), as arrays."""

    def run(batches):
        for part, block in pair.blocks(batches):
            own_a, own_b = block.a_of[:-1], block.b_of[:-1]
            in_group = np.diff(block.group_of)
            ends_a, ends_b = block.group_a - np.repeat(own_a, in_group), block.group_b - np.repeat(own_b, in_group)
            columns = [part.column(0), _nested(block.a, block.a_of), _nested(block.b, block.b_of), _nested(ends_a, block.group_of), _nested(ends_b, block.group_of)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "a_ids", "b_ids", "a_ends", "b_ends"])

    schema = "doc_id long, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>"
    return common.map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)


def linked(docs: DataFrame, pair: Pair) -> DataFrame:
    """Per document the numbers and the digest of its groups, and its distinct id pairs with how often it links them (binary)."""

    def run(batches):
        for part, block in pair.blocks(batches):
            of, keys, times = block.pairs()
            raw, often, size = keys.astype(pair.type).tobytes(), times.astype("<u4").tobytes(), np.dtype(pair.type).itemsize
            spans = list(itertools.pairwise(of.tolist()))
            numbers = [np.diff(block.a_of), np.diff(block.b_of), np.diff(block.group_of), block.n_links]
            columns = [part.column(0), *(pa.array(x, pa.int64()) for x in numbers), pa.array(block.group_digests(), pa.string())]
            columns.append(pa.array([raw[size * x : size * y] for x, y in spans], pa.binary()))
            columns.append(pa.array([often[4 * x : 4 * y] for x, y in spans], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"
    return common.map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)


def _links_of(batch, pair_type: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs and their times of a batch of rows, and the row of each."""
    pairs, times = batch.column("pairs").to_pylist(), batch.column("times").to_pylist()
    row = np.repeat(np.arange(len(times)), [len(t) // 4 for t in times])
    return np.frombuffer(b"".join(pairs), pair_type).astype(np.int64), np.frombuffer(b"".join(times), "<u4").astype(np.int64), row


def pair_counts(links: DataFrame, pair_type: str, right: int) -> DataFrame:
    """pair, n, best: how many links of the corpus hold it, and whether no other pair of its B id has more."""

    def run(batches):
        for batch in batches:
            key, times, _ = _links_of(batch, pair_type)
            own, at = np.unique(key, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.bincount(at, times, len(own)).astype(np.int64))], names=["pair", "n"])

    counts = common.map_arrow(links.select("pairs", "times"), run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    top = F.max("n").over(Window.partitionBy(F.pmod("pair", F.lit(right))))  # a B id has at most |A| pairs
    return counts.withColumn("best", F.col("n") == top)


def with_counts(links: DataFrame, counts: DataFrame, pair_type: str) -> DataFrame:
    """The rows of ``links`` with n_best and count_sum, as far as the pairs of ``counts`` (broadcast) go."""
    table = counts.orderBy("pair").toArrow()
    known = tuple(table.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "n", "best"))
    shared = links.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        keys, n, best = shared.value
        for batch in batches:
            key, times, row = _links_of(batch, pair_type)
            at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
            hit = keys[at] == key if len(keys) else np.zeros(len(key), bool)
            at, times, row = at[hit], times[hit], row[hit]
            n_best, count_sum = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(n_best, row, times * best[at])
            np.add.at(count_sum, row, times * n[at])
            rest = batch.drop_columns(["pairs", "times"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(n_best), pa.array(count_sum)], names=[*rest.schema.names, "n_best", "count_sum"])

    schema = links.drop("pairs", "times").withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")}).schema
    return common.map_arrow(links, run, schema)


def alignment_statistics(docs: DataFrame, pair: Pair, most: int = PAIRS) -> DataFrame:
    """One row per document: its numbers of tokens, groups and links, and the corpus-wide counts of its links."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-links")
    linked(docs, pair).withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    links = spark.read.parquet(path)
    counts = common.shared_checkpoint(pair_counts(links, pair.type, pair.sizes[1]))
    blocks = max(1, -(-counts.count() // most))
    if blocks == 1:
        return with_counts(links.drop("row"), counts, pair.type)
    parts = []
    for k in range(blocks):  # as many as the vocabularies have pairs, at most; each is written before the next is broadcast
        own = counts.where(F.pmod(F.xxhash64(F.pmod("pair", F.lit(pair.sizes[1]))), F.lit(blocks)) == k)
        parts.append(scratch_path(spark, f"token-links-{k}"))
        with_counts(links.select("row", "pairs", "times"), own, pair.type).write.parquet(parts[-1])
    sums = spark.read.parquet(*parts).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return links.drop("pairs", "times").join(sums, "row").drop("row")


def op11_token_alignment(spark, sf_dir: str) -> DataFrame:
    out = alignment_statistics(common.documents(spark, sf_dir), public_pair(spark))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
