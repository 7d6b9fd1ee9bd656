"""Byte-level BPE encoding and decoding with a segment tree of pair ranks.

A text is cut at added tokens, then by the pre-tokenizer's pattern. Each distinct piece is
encoded once a batch: its bytes are the first symbols, and a segment tree over its adjacent
pairs holds at its root the lowest merge rank and, among equal ranks, the leftmost position.
Each step merges the root's pair and updates three leaves in logarithmic time, until the root
holds no merge. The trees of all new pieces of a batch are advanced together in numpy.

The vocabulary file is read on the driver and broadcast: its size is fixed by the vocabulary.
A task keeps the pieces it has met in a memo of at most ``MEMO_PIECES`` pieces and
``MEMO_BYTES`` piece bytes, emptied when full; that changes the time, not the result.

Defined cases: very long texts are encoded whole (a piece without a break costs about 0.1 ms a
byte); a null text is an empty one and has no tokens; text that spells an added token
becomes that token; repeated rows each get their result; an empty table gives an empty one.
Other columns of the input are not read.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultlens.llm.common import read_table

# The pre-tokenizer's pattern of byte-level BPE files.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO_PIECES = 400_000
MEMO_BYTES = 32 << 20
BATCH_CHARS = 4 << 20    # characters of text worked on and returned at a time
CELLS = 1 << 20          # leaves of the trees advanced together
_NONE = np.int64(1) << 62


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself if printable Latin-1, else the next free from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Bpe:
    """Tables of one vocabulary file. ``encode_pieces`` maps pieces to ids, ``decode`` ids to bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        letters = _byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*vocab.values(), *self.added.values()]) + 1
        self.token_bytes = [b""] * self.size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(byte_of[c] for c in token)
        for token, i in self.added.items():
            self.token_bytes[i] = token.encode("utf-8")
        self.byte_ids = np.array([vocab[c] for c in letters], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], _NONE)

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        classes: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if p:
                classes.setdefault(1 << (len(p) - 1).bit_length(), []).append(i)
        for width, members in classes.items():
            step = max(1, CELLS // width)
            for k in range(0, len(members), step):
                part = members[k:k + step]
                for i, ids in zip(part, self._encode_block([pieces[i] for i in part], width)):
                    out[i] = ids
        return out

    def _encode_block(self, pieces: list[bytes], width: int) -> list[bytes]:
        n = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8)
        rows, place = len(pieces), np.arange(width)
        symbol = np.zeros((rows, width + 1), dtype=np.int64)
        symbol[:, :width] = self.byte_ids[raw.reshape(rows, width)]
        live = place < n[:, None]
        follow = np.empty((rows, width + 1), dtype=np.int32)     # next live place; ``width``: none
        follow[:, :width] = np.where(place + 1 < n[:, None], place + 1, width)
        before = np.empty((rows, width + 1), dtype=np.int32)
        before[:, :width] = np.where(place > 0, place - 1, width)
        shift = width.bit_length() - 1
        tree = np.full((rows, 2 * width), _NONE, dtype=np.int64)

        def key(left, right, at, valid):
            rank = self._rank(left, right)
            return np.where(valid & (rank < _NONE), (rank << shift) | at, _NONE)

        tree[:, width:] = key(symbol[:, :width], symbol[:, 1:], place, follow[:, :width] < width)
        h = width // 2
        while h:
            tree[:, h:2 * h] = np.minimum(tree[:, 2 * h:4 * h:2], tree[:, 2 * h + 1:4 * h:2])
            h //= 2
        flat = tree.reshape(-1)

        def put(r, at, value):
            base, node = r * (2 * width), at + width
            flat[base + node] = value
            for _ in range(shift):
                node = node >> 1
                flat[base + node] = np.minimum(flat[base + 2 * node], flat[base + 2 * node + 1])

        r = np.arange(rows)
        while True:
            root = tree[r, 1]
            r, root = r[root < _NONE], root[root < _NONE]
            if not len(r):
                break
            at = root & (width - 1)
            joined = self.merged[root >> shift]
            gone = follow[r, at]
            after, prior = follow[r, gone], before[r, at]
            symbol[r, at], follow[r, at], before[r, after] = joined, after, at
            live[r, gone] = False
            put(r, gone.astype(np.int64), _NONE)
            put(r, at, key(joined, symbol[r, after], at, after < width))
            some = prior < width
            q, left = r[some], prior[some].astype(np.int64)
            put(q, left, key(symbol[q, left], joined[some], left, True))
        ids = symbol[:, :width][live].astype("<u4").tobytes()
        end = np.cumsum(live.sum(axis=1)) * 4
        return [ids[a:b] for a, b in zip([0, *end[:-1].tolist()], end.tolist())]

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.token_bytes.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


class Encoder:
    """Encodes texts; keeps the memo of pieces. Without ``added``, their strings are ordinary text."""

    def __init__(self, bpe: Bpe, pattern: str = PIECES, added: bool = True):
        self.bpe, self.memo, self.held = bpe, {}, 0
        self.find = regex.compile(pattern).findall
        names = sorted(bpe.added, key=len, reverse=True) if added else []
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split if names else None
        self.special = {name: np.array([i], dtype="<u4").tobytes() for name, i in bpe.added.items() if added}

    def _parts(self, text: str) -> list[tuple[bytes | None, list[str]]]:
        """(ids of an added token or None, pieces) in order."""
        if self.cut is None or not any(name in text for name in self.special):
            return [(None, self.find(text))]
        return [(self.special[x], []) if k % 2 else (None, self.find(x)) for k, x in enumerate(self.cut(text))]

    def encode(self, texts: list[str]) -> list[bytes]:
        parts = [self._parts(t) for t in texts]
        new = {p for doc in parts for _, pieces in doc for p in pieces}
        fresh = [p for p in new if p not in self.memo]
        size = sum(map(len, fresh))
        if len(self.memo) + len(fresh) > MEMO_PIECES or self.held + size > MEMO_BYTES:
            self.memo, self.held, fresh = {}, 0, list(new)
            size = sum(map(len, fresh))
        self.memo.update(zip(fresh, self.bpe.encode_pieces([p.encode("utf-8") for p in fresh])))
        self.held += size
        get = self.memo.__getitem__
        return [b"".join(special or b"".join(map(get, pieces)) for special, pieces in doc) for doc in parts]


def _texts(column) -> list[str]:
    return [v.decode("utf-8", "replace") if v else "" for v in column.cast(pa.binary()).to_pylist()]


def _slices(lengths: list[int], most: int):
    """(start, end) of consecutive rows of about ``most`` in total, one row at least."""
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if lengths:
        yield start, len(lengths)


def text_batches(batches, column: int):
    """Cuts Arrow batches so that each holds about ``BATCH_CHARS`` bytes of that column."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(column)), 0).to_pylist()
        for s, e in _slices(sizes, BATCH_CHARS):
            yield b.slice(s, e - s)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, ids`` per row; ``ids`` are little-endian unsigned 32-bit integers."""
    return _run(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), path, False)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode`` plus ``decoded``, the text that those ids decode to."""
    return _run(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), path, True)


def with_tokens(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``n_tokens``, ``ids`` and ``lossless`` (the ids decode to the text). Where ``docs``
    has a column of such a name, it stays as it is and the new one is called ``token_<name>``."""
    cols = docs.columns
    taken = {c.lower() for c in cols}

    def free(name):
        while name in taken:
            name = f"token_{name}"
        return name

    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("id"), F.col(f"`{text_col}`").alias("text"))
    d = _run(row, path, True)
    text = F.coalesce(F.col("id").getField(text_col).cast("string"), F.lit(""))
    return d.select(*[F.col("id").getField(c).alias(c) for c in cols], F.col("n_tokens").alias(free("n_tokens")),
                    F.col("ids").alias(free("ids")), (F.col("decoded") == text).alias(free("lossless")))


def _run(rows, path, decoded):
    bpe = rows.sparkSession.sparkContext.broadcast(Bpe(path))
    src = rows.select("id", F.col("text").cast("string"))

    def run(batches):
        encoder = Encoder(bpe.value)
        for b in text_batches(batches, 1):
            ids = encoder.encode(_texts(b.column(1)))
            cols = [b.column(0), pa.array([len(x) // 4 for x in ids], type=pa.int64()), pa.array(ids, type=pa.binary())]
            if decoded:
                cols.append(pa.array([encoder.bpe.decode(x) for x in ids], type=pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names=["id", "n_tokens", "ids", "decoded"][:len(cols)])

    id_type = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {id_type}, n_tokens long, ids binary" + ", decoded string" * decoded)


def decode(tokens: DataFrame, path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """``id, decoded`` per row of token ids; null ids decode to an empty text."""
    bpe = tokens.sparkSession.sparkContext.broadcast(Bpe(path))
    src = tokens.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{ids_col}`").alias("ids"))

    def run(batches):
        for b in text_batches(batches, 1):
            text = [bpe.value.decode(x or b"") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, type=pa.string())], names=["id", "decoded"])

    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, decoded string")


def op5_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = round_trip(read_table(spark, sf_dir, "documents"), default_vocabulary())
    return d.select(F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                    F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
