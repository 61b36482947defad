"""Op 4: sampled segmentations of texts into the pieces of a SentencePiece vocabulary, and their exact inverse.

Every path through the lattice of pieces over a text's bytes has the probability of its pieces' weights; forward
filtering sums the paths to each position, backward sampling draws one. Draws depend on the seed, the row's key and the
position only, so a rerun on other partitions gives the same pieces. Characters that are no piece are spelled in byte
pieces. Blanks are the pieces' `▁`; nothing is normalised, added or dropped, so decoding gives back each byte.

Where no piece can stand across two neighbouring bytes, all paths meet: a text is cut there, equal parts share one
lattice, and the parts of many texts are filtered and sampled together as arrays.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .registry import batch, column, map_batches, query, read
from .words import _BACK, _STEP, _WEIGHT, Texts, _powers, mixed, spans_hash, texts

#: The vocabulary of the query; a path on every executor.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Exponent on the pieces' weights: 0 draws all paths alike, large values the likeliest.
ALPHA = 0.5
#: Distinct parts a worker keeps the lattices of; beyond it, it starts anew.
KEPT_PARTS = 100_000
_BLANK = "▁"


class Vocabulary(NamedTuple):
    spelled: list[bytes]  # by id; what a piece stands for
    byte_ids: np.ndarray  # id of the piece of each single byte
    by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # bytes -> sorted keys, ids, log weights
    byte_weight: float
    joined: np.ndarray  # whether some piece holds this pair of bytes, across a character boundary
    sizes: np.ndarray  # bytes of each id
    starts: np.ndarray  # where each id begins in `flat`
    flat: np.ndarray


def _keys(data: np.ndarray) -> np.ndarray:
    """Polynomial key of each row of bytes."""
    return (_WEIGHT[data] * _powers(_STEP, data.shape[1])).sum(axis=1, dtype=np.uint64)


def vocabulary(path: str) -> Vocabulary:
    """A model file, read once. Scores are log weights; those of a BPE model are merge ranks, weighted by Zipf's law."""
    if path not in _vocabularies:
        _vocabularies[path] = _read(path)
    return _vocabularies[path]


def _read(path: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    byte_ids, spelled, usable, scores = np.full(256, -1), [], [], []
    for i in range(n):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            value = int(re.fullmatch("<0x([0-9A-F]{2})>", piece)[1], 16)
            byte_ids[value] = i
            spelled.append(bytes([value]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            spelled.append(b"")
        else:
            spelled.append(piece.replace(_BLANK, " ").encode())
            usable.append(i)
            scores.append(model.get_score(i))
    if (byte_ids < 0).any():
        raise ValueError(f"{path}: a vocabulary without all byte pieces cannot spell every text")
    scores = np.array(scores)
    ranked = np.isin(scores, -np.arange(n + 1.0)) | (scores <= -n)
    weights = -np.log(2 + np.minimum(-scores, n)) if ranked.all() else scores
    by_size, joined = {}, np.zeros((256, 256), bool)
    for size in sorted({len(spelled[i]) for i in usable}):
        ids = np.array([i for i in usable if len(spelled[i]) == size])
        data = np.frombuffer(b"".join(spelled[i] for i in ids), np.uint8).reshape(-1, size)
        keys = _keys(data)
        order = np.argsort(keys)
        place = np.searchsorted(usable, ids)
        by_size[size] = keys[order], ids[order], weights[place][order]
        for at in range(1, size):
            joined[data[:, at - 1], data[:, at]] = True
    sizes = np.array([len(s) for s in spelled])
    return Vocabulary(
        spelled, byte_ids, by_size, float(weights.min() - np.log(256)), joined, sizes, np.cumsum(sizes) - sizes,
        np.frombuffer(b"".join(spelled), np.uint8),
    )


_vocabularies: dict[str, Vocabulary] = {}


class Lattice(NamedTuple):
    """Edges into every (part, position), sorted by it: their running probability, bytes and piece id (-1: spelled)."""

    until: np.ndarray
    size: np.ndarray
    piece: np.ndarray


def lattices(rows: np.ndarray, words: Vocabulary, alpha: float) -> tuple[np.ndarray, ...]:
    """Edges of parts of one length (rows of bytes): part, end, bytes, piece, and probability given the end."""
    n, m = rows.shape
    up, down = _powers(_STEP, m + 1), _powers(_BACK, m + 1)
    sums = np.zeros((n, m + 1), np.uint64)
    np.cumsum(_WEIGHT[rows] * up[:m], axis=1, out=sums[:, 1:])
    found: list[list[tuple]] = [[] for _ in range(m + 1)]  # by end: (bytes, rows, pieces, weights)
    known = np.zeros((n, m), bool)  # a piece of one character begins here
    lead = (rows & 0xC0) != 0x80
    width = np.where(rows < 0x80, 1, np.where(rows < 0xE0, 2, np.where(rows < 0xF0, 3, 4)))
    for size, (keys, ids, weights) in words.by_size.items():
        if size > m:
            continue
        have = (sums[:, size:] - sums[:, : m + 1 - size]) * down[: m + 1 - size]
        at = np.minimum(np.searchsorted(keys, have), len(keys) - 1)
        hit = (keys[at] == have) & lead[:, : m + 1 - size]
        row, start = np.nonzero(hit)
        single = width[row, start] == size
        known[row[single], start[single]] = True
        order = np.argsort(start, kind="stable")
        row, start, at = row[order], start[order], at[row, start][order]
        cuts = np.searchsorted(start, np.arange(m + 2 - size))
        for s in np.flatnonzero(np.diff(cuts)):
            part = slice(cuts[s], cuts[s + 1])
            found[s + size].append((size, row[part], ids[at[part]], weights[at[part]] * alpha))
    row, start = np.nonzero(lead & ~known)
    for size in (1, 2, 3, 4):
        mine = (width[row, start] == size) & (start + size <= m)
        for end in np.unique(start[mine]) + size:
            here = row[mine][start[mine] + size == end]
            found[end].append((size, here, np.full(len(here), -1), np.full(len(here), size * words.byte_weight * alpha)))
    reached = np.full((n, m + 1), -np.inf)
    reached[:, 0] = 0
    out = []
    for end in range(1, m + 1):
        if not found[end]:
            continue
        row = np.concatenate([f[1] for f in found[end]])
        size = np.repeat([f[0] for f in found[end]], [len(f[1]) for f in found[end]])
        piece = np.concatenate([f[2] for f in found[end]])
        value = np.concatenate([f[3] for f in found[end]]) + reached[row, end - size]
        top = np.full(n, -np.inf)
        np.maximum.at(top, row, value)
        share = np.exp(value - np.where(np.isfinite(top), top, 0)[row])
        total = np.bincount(row, weights=share, minlength=n)
        with np.errstate(divide="ignore"):
            reached[:, end] = np.where(total > 0, np.log(total) + np.where(np.isfinite(top), top, 0), -np.inf)
        ok = share > 0
        out.append((row[ok], np.full(ok.sum(), end), size[ok], piece[ok], share[ok] / total[row[ok]]))
    return tuple(np.concatenate(c) for c in zip(*out))


class Sampler:
    """Lattices of the parts seen so far in a worker, and draws from them."""

    def __init__(self, words: Vocabulary, alpha: float, seed: int):
        self.words, self.alpha, self.seed = words, alpha, seed
        self.forget()

    def forget(self) -> None:
        self.keys, self.bases, self.nodes = np.empty(0, np.uint64), np.empty(0, np.int64), 0
        self.lattice = Lattice(np.empty(0), np.empty(0, np.int16), np.empty(0, np.int32))

    def learn(self, data: np.ndarray, keys: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        """Add the lattices of parts that are new."""
        fresh, first = np.unique(keys, return_index=True)
        new = ~np.isin(fresh, self.keys, assume_unique=True)
        fresh, first = fresh[new], first[new]
        sizes = end[first] - start[first]
        order = np.argsort(sizes, kind="stable")
        fresh, first, sizes = fresh[order], first[order], sizes[order]
        bases = self.nodes + np.cumsum(sizes + 1) - (sizes + 1)
        parts = []
        for size in np.unique(sizes):
            mine = np.flatnonzero(sizes == size)
            for some in np.array_split(mine, max(1, len(mine) * int(size) // 400_000)):
                rows = data[start[first[some]][:, None] + np.arange(size)]
                part, at, length, piece, share = lattices(rows, self.words, self.alpha)
                node = bases[some][part] + at
                order = np.argsort(node, kind="stable")
                node, share = node[order], share[order]
                until = np.cumsum(share)
                begins = np.concatenate([[True], node[1:] != node[:-1]])
                before = (until - share)[begins][np.cumsum(begins) - 1]
                until = np.minimum(until - before, 1.0)
                until[np.append(begins[1:], True)] = 1.0
                parts.append((node + until, length[order].astype(np.int16), piece[order].astype(np.int32)))
        if parts:
            added = [np.concatenate(c) for c in zip(*parts)]
            self.lattice = Lattice(*(np.concatenate([old, new]) for old, new in zip(self.lattice, added)))
            self.nodes += int((sizes + 1).sum())
            have, at = np.concatenate([self.keys, fresh]), np.concatenate([self.bases, bases])
            order = np.argsort(have)
            self.keys, self.bases = have[order], at[order]

    def encode(self, chunk: Texts, row_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts in order, and where each text begins in them."""
        data = chunk.data
        n = len(data)
        if not n:
            return np.empty(0, np.int32), np.zeros(chunk.n + 1, np.int64)
        cut = np.ones(n, bool)
        cut[1:] = ~self.words.joined[data[:-1], data[1:]] & ((data[1:] & 0xC0) != 0x80)
        cut[chunk.offsets[:-1][np.diff(chunk.offsets) > 0]] = True
        start = np.flatnonzero(cut)
        end = np.append(start[1:], n)
        keys = spans_hash(data, start, end)
        if len(self.keys) > KEPT_PARTS:
            self.forget()
        self.learn(data, keys, start, end)
        base = self.bases[np.searchsorted(self.keys, keys)]
        text = np.searchsorted(chunk.offsets, start, "right") - 1
        place = (start - chunk.offsets[text]).astype(np.uint64)
        stream = mixed(row_keys[text].astype(np.uint64) * np.uint64(_STEP) + np.uint64(self.seed)) + place * np.uint64(_BACK)
        out = np.full(n, -1, np.int32)
        at, until, size, piece = end - start, *self.lattice
        while len(at):
            draw = (mixed(stream + at.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
            edge = np.searchsorted(until, base + at + draw, "right")
            length, found = size[edge], piece[edge]
            at = at - length
            whole = found >= 0
            out[start[whole] + at[whole]] = found[whole]
            spelled = np.flatnonzero(~whole)
            for k in range(4):
                some = spelled[length[spelled] > k]
                where = start[some] + at[some] + k
                out[where] = self.words.byte_ids[data[where]]
            more = at > 0
            at, base, start, stream = at[more], base[more], start[more], stream[more]
        kept = out >= 0
        bounds = np.concatenate([[0], np.cumsum(kept)])[chunk.offsets]
        return out[kept], bounds


def decoded(ids: np.ndarray, words: Vocabulary) -> np.ndarray:
    """The bytes that some ids stand for, one after the other."""
    sizes = words.sizes[ids]
    total = np.cumsum(sizes)
    return words.flat[np.repeat(words.starts[ids] - (total - sizes), sizes) + np.arange(total[-1] if len(total) else 0)]


def encode_texts(
    df: DataFrame, key: Column, id_column: str = "doc_id", text_column: str = "text", path: str = VOCABULARY, alpha: float = ALPHA, seed: int = 0,
) -> DataFrame:
    """One row per row of `df`: doc_id, pieces (ids; null for a null text), n_pieces and lossless.

    `key` is a long column that seeds a row's draws; rows with one key and one text get the same pieces. An empty text has
    no pieces. lossless says that decoding gives the text back byte for byte (checked for each text; true for a null).
    Extra columns are not read; an empty table gives no rows.
    """
    docs = df.select(column(df, id_column).alias("doc_id"), key.alias("key"), column(df, text_column).alias("text"))
    kind = dict(docs.dtypes)["doc_id"].replace("bigint", "long")
    schema = f"doc_id {kind}, pieces array<int>, n_pieces long, lossless boolean"

    def encode(batches):
        sampler = Sampler(vocabulary(path), alpha, seed)
        for part in batches:
            if part.num_rows:
                yield from encode_part(part, sampler)

    def encode_part(part, sampler):
        words = sampler.words
        null = part.column("text").is_null().to_numpy(zero_copy_only=False)
        keys = part.column("key").fill_null(0).to_numpy(zero_copy_only=False)
        ids = part.column("doc_id")
        for chunk in texts(part.column("text")):
            rows = slice(chunk.first, chunk.first + chunk.n)
            found, bounds = sampler.encode(chunk, keys[rows])
            back = decoded(found, words)
            ends = np.concatenate([[0], np.cumsum(words.sizes[found])])[bounds]
            same = ends[1:] - ends[:-1] == np.diff(chunk.offsets)
            if not (same.all() and np.array_equal(back, chunk.data)):
                same &= np.array([np.array_equal(back[a:b], chunk.data[c:d]) for a, b, c, d in zip(ends, ends[1:], chunk.offsets, chunk.offsets[1:])])
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(found, pa.int32()), mask=pa.array(null[rows]))
            yield batch(schema, ids.slice(chunk.first, chunk.n), lists.cast(pa.list_(pa.int32())), np.diff(bounds), pa.array(same))

    return docs.mapInArrow(encode, schema)


def decode_texts(df: DataFrame, id_column: str = "doc_id", pieces_column: str = "pieces", path: str = VOCABULARY) -> DataFrame:
    """One row per row of `df`: doc_id and the text its pieces stand for; null pieces give a null text, none an empty one.

    Ids of control pieces stand for nothing; bytes that are no UTF-8, from pieces that no text gave, become U+FFFD.
    """
    rows = df.select(column(df, id_column).alias("doc_id"), column(df, pieces_column).alias("pieces"))
    schema = f"doc_id {dict(rows.dtypes)['doc_id'].replace('bigint', 'long')}, text string"

    def decode(part):
        words = vocabulary(path)
        found = [
            None if ids is None else decoded(np.array(ids, np.int64), words).tobytes().decode("utf-8", "replace") for ids in part.column("pieces").to_pylist()
        ]
        yield batch(schema, part.column("doc_id"), found)

    return map_batches(rows, decode, schema)


def row_key(id_column: Column) -> Column:
    return F.xxhash64(id_column.cast("string"))


@query("op4_sentencepiece_sampling")
def op4_sentencepiece_sampling(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return encode_texts(docs, row_key(F.col("doc_id")))
