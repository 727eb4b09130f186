"""SentencePiece encoding by forward filtering and backward sampling, and lossless decoding.

A text gets a word-start mark in front and one for each space. Its lattice has an edge for every
piece of the vocabulary that fits, and for a character that is no piece (a mark written in the text
is one) an edge of its UTF-8 bytes. A piece weighs 1 / (2 + rank), rank being its place in the
vocabulary's merge order, to the power ``sharpness``. No piece crosses from a character into a
following mark, nor holds a character that is only ever a piece alone, so the lattice falls into
words, and each distinct word of a batch is filtered once: the forward sums give, at each place,
the exact chance of every piece that ends there. Sampling walks all words backward in step; the
draw for a piece is a hash of the seed, the row's key and the place where the piece ends, so a row
is segmented alike in any batch or run.

A word of more than ``LONG`` characters is filtered in stretches: as no piece is longer than ``longest``,
what a stretch does to the last ``longest`` forward sums is a matrix. The matrices of a block's stretches are made
side by side, chained, and the stretches are then filtered side by side from their true sums, with
a choice for each place; the walk backward follows the choices.

Decoding joins the pieces' bytes and drops the first mark: every text comes back byte for byte.

Defined results: a null text gives null pieces, an empty one the mark alone; a null key counts as
0; repeated rows are segmented alike; long texts are cut between words, long words are filtered in stretches; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitmill.llm.wordvec import mix
from pitmill.llm.workers import lean

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK, PLAIN_MARK = 0x2581, 0x110000
CHARS = 1 << 18
#: A longer word is filtered in blocks of so many stretches of so many characters.
LONG, STRETCHES, STRETCH = 1024, 512, 256
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Vocabulary:
    raw: list[bytes]  # the bytes of each id, marks as spaces
    weight: np.ndarray
    first_byte: int  # id of byte 0
    key: np.ndarray  # sorted hashes of the pieces
    ident: np.ndarray  # their ids
    maybe: np.ndarray  # a bit for each low half of a key
    longest: int
    inner: np.ndarray  # code points that are part of a longer piece, sorted
    byte_weight: float


_POWER: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWER or len(_POWER[0]) < n:
        n = max(n, CHARS + 4096)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _POWER[:] = [np.cumprod(np.append(np.uint64(1), np.full(n - 1, b, np.uint64))) for b in (_BASE, inverse)]
    return _POWER[0], _POWER[1]


def _sums(points: np.ndarray) -> np.ndarray:
    out = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * _powers(len(points) + 1)[0][: len(points)], out=out[1:])
    return out


def load(path: str = MODEL, sharpness: float = 1.0) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    pieces = {i: sp.id_to_piece(i) for i in plain}
    byte = [i for i in range(n) if sp.is_byte(i)]
    if len(byte) != 256 or byte != list(range(byte[0], byte[0] + 256)):
        raise ValueError("the model must have byte fallback")
    if any("▁" in p.lstrip("▁") for p in pieces.values()):
        raise ValueError("a piece crosses into a word start")
    rank = {i: -sp.get_score(i) if sp.get_score(i) > -1e8 else float(i) for i in plain}
    weight = np.full(n, -np.inf)
    for i in plain:
        weight[i] = -sharpness * np.log(2 + max(0.0, rank[i]))
    raw = [b""] * n
    for i, p in pieces.items():
        raw[i] = p.replace("▁", " ").encode()
    for k, i in enumerate(byte):
        raw[i] = bytes([k])
    key = np.array([int(_sums(np.array([ord(c) for c in p], np.uint32))[-1]) for p in pieces.values()], np.uint64)
    key = mix(key ^ np.array([len(p) for p in pieces.values()], np.uint64))
    order = np.argsort(key)
    maybe = np.zeros(1 << 20, bool)
    maybe[key & np.uint64((1 << 20) - 1)] = True
    inner = sorted({ord(c) for p in pieces.values() if len(p) > 1 for c in p})
    return Vocabulary(raw, weight, byte[0], key[order], np.array(plain)[order], maybe, max(map(len, pieces.values())), np.array(inner, np.uint32), -sharpness * float(np.log(2 + n)))


def _edges(v: Vocabulary, points: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, id) of all edges over distinct words laid end to end; ``left``: characters from each to its word's end. Id -1: bytes."""
    total, inverse = _sums(points), _powers(len(points) + 1)[1]
    begin, end, ident = [], [], []
    for size in range(1, v.longest + 1):
        at = np.flatnonzero(left >= size)
        if not len(at):
            break
        key = mix(((total[at + size] - total[at]) * inverse[at]) ^ np.uint64(size))
        may = v.maybe[key & np.uint64((1 << 20) - 1)]
        place = np.minimum(np.searchsorted(v.key, key[may]), len(v.key) - 1)
        is_piece = v.key[place] == key[may]
        got = at[may][is_piece]
        begin.append(got)
        end.append(got + size)
        ident.append(v.ident[place[is_piece]])
        if size == 1:
            alone = np.ones(len(points), bool)
            alone[got] = False
            rest = np.flatnonzero(alone)
            begin.append(rest)
            end.append(rest + 1)
            ident.append(np.full(len(rest), -1))
    return np.concatenate(begin), np.concatenate(end), np.concatenate(ident)


def _utf8(points: np.ndarray) -> list[bytes]:
    return [("▁" if p == PLAIN_MARK else chr(p)).encode("utf-8", "surrogateescape") for p in points.tolist()]


def _weights(v: Vocabulary, points: np.ndarray, begin: np.ndarray, ident: np.ndarray) -> np.ndarray:
    """Log-weight of each edge."""
    w = v.weight[ident]
    by_bytes = ident < 0
    if by_bytes.any():
        p = points[begin[by_bytes]]
        width = 1 + (p > 0x7F) + (p > 0x7FF) + ((p > 0xFFFF) & (p != PLAIN_MARK))
        width = np.where((p >= 0xDC80) & (p <= 0xDCFF), 1, width)
        w[by_bytes] = v.byte_weight * width
    return w


def sample_long(v: Vocabulary, points: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, id) of the sampled pieces of one long word, last first; ``draw``: 32 bits for a piece that ends after each character."""
    n, most, block = len(points), v.longest, STRETCHES * STRETCH
    size, ident = np.empty(n, np.uint8), np.empty(n, np.int32)
    last = np.zeros(most)  # forward sums after the last characters, newest at the end
    last[-1] = 1
    for lo in range(0, n, block):
        hi, before = min(n, lo + block), max(0, lo - most)
        part = points[before:hi]
        begin, end, which = _edges(v, part, np.arange(len(part), 0, -1))
        inside = end > lo - before
        begin, end, which = begin[inside], end[inside], which[inside]
        length = end - begin
        stretches = -(-(hi - lo) // STRETCH)
        # places beyond the end pass the sums on; longer pieces first, as in ``last``
        weight, piece = np.zeros((stretches * STRETCH, most)), np.full((hi - lo, most), -2, np.int32)
        weight[hi - lo :, most - 1] = 1
        weight[end - 1 - (lo - before), most - length] = np.exp(_weights(v, part, begin, which))
        piece[end - 1 - (lo - before), length - 1] = which
        weight = weight.reshape(stretches, STRETCH, most)
        state = np.repeat(np.eye(most)[None], stretches, axis=0)  # (stretch, first sums, last sums)
        for t in range(STRETCH):
            new = np.einsum("sbk,sk->sb", state, weight[:, t])
            state = np.concatenate((state[:, :, 1:], new[:, :, None]), axis=2)
            if t % 8 == 7:  # only ratios within a stretch count
                state /= np.maximum(state.max(axis=(1, 2)), 1e-300)[:, None, None]
        starts = np.empty((stretches, most))
        for k in range(stretches):
            starts[k] = last
            last = last @ state[k]
            last = last / last.max()
        now = starts
        for t in range(STRETCH):
            place = np.arange(stretches) * STRETCH + t
            chance = weight[:, t] * now
            total = chance.sum(axis=1)
            run = np.cumsum(chance[:, ::-1], axis=1) / total[:, None]  # shorter pieces first
            now = np.concatenate((now[:, 1:], total[:, None]), axis=1)
            if t % 8 == 7:
                now /= now.max(axis=1, keepdims=True)
            real = place < hi - lo
            part_of = np.minimum(np.floor(run[real] * 2.0**32), 2.0**32 - 1)
            chosen = (part_of < draw[lo + place[real], None]).sum(axis=1)
            longest = most - 1 - (chance[real] > 0).argmax(axis=1)
            chosen = np.minimum(chosen, longest)
            size[lo + place[real]] = chosen + 1
            ident[lo + place[real]] = piece[place[real], chosen]
    begins, at, sizes = [], n, size.tolist()
    while at:
        at -= sizes[at - 1]
        begins.append(at)
    ends = np.array([n, *begins[:-1]])
    return np.array(begins), ident[ends - 1]


def filter_words(v: Vocabulary, points: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges (begin, id) in the order of their ends, and for each a threshold: end * 2**32 + the summed chance up to it."""
    offset = np.arange(len(points)) - np.repeat(first, size)
    begin, end, ident = _edges(v, points, np.repeat(size, size) - offset)
    w = _weights(v, points, begin, ident)
    # place j of a word and all others' place j are summed together; an end is kept as its last character
    step = offset[end - 1]
    order = np.argsort((step << 42) | (end << 12) | np.minimum(end - begin, 4095))
    begin, end, ident, w, step = begin[order], end[order], ident[order], w[order], step[order]
    is_first = np.zeros(len(points) + 1, bool)
    is_first[first] = True
    after = np.zeros(len(points))  # forward sum after each character
    value = np.empty(len(w))
    for lo, hi in zip(*(lambda c: (c[:-1], c[1:]))(np.append(np.flatnonzero(np.append(True, step[1:] != step[:-1])), len(step))), strict=True):
        b, e = begin[lo:hi], end[lo:hi] - 1
        x = np.where(is_first[b], 0.0, after[b - 1]) + w[lo:hi]
        seg = np.flatnonzero(np.append(True, e[1:] != e[:-1]))
        top = np.maximum.reduceat(x, seg)
        n = np.diff(np.append(seg, len(e)))
        s = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, n)), seg))
        after[e[seg]] = s
        value[lo:hi] = np.exp(x - np.repeat(s, n))
    order = np.argsort((end << 12) | np.minimum(end - begin, 4095))
    begin, end, ident, value = begin[order], end[order], ident[order], value[order]
    seg = np.flatnonzero(np.append(True, end[1:] != end[:-1]))
    n = np.diff(np.append(seg, len(end)))
    run = np.cumsum(value)
    run = run - np.repeat(run[seg] - value[seg], n)
    part = np.minimum(np.floor(run * 2.0**32), 2.0**32 - 1).astype(np.int64)
    part[np.append(seg[1:], len(end)) - 1] = 2**32 - 1
    return begin, ident, end.astype(np.int64) * 2**32 + part


def _points(text: str) -> np.ndarray:
    p = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(p == MARK, np.uint32(PLAIN_MARK), np.where(p == 32, np.uint32(MARK), p))


def _segments(text: str) -> Iterator[str]:
    """Parts of about CHARS characters, cut before a space that follows another character."""
    at = 0
    while len(text) - at > CHARS:
        cut = text.find(" ", at + CHARS)
        while cut > 0 and text[cut - 1] == " ":
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def encode_texts(v: Vocabulary, texts: list[bytes | None], keys: list[int], seed: int = 0) -> list[np.ndarray | None]:
    """The sampled ids of each text."""
    out: list = [None if t is None else [] for t in texts]
    held: list[tuple[int, int, np.ndarray]] = []
    size = 0
    for i, t in enumerate(texts):
        if t is None:
            continue
        at = 0
        for k, part in enumerate(_segments(t.decode("utf-8", "surrogateescape"))):
            p = _points(part)
            p = np.append(np.uint32(MARK), p) if k == 0 else p
            if held and size + len(p) > CHARS:
                _sample(v, held, keys, seed, out)
                held, size = [], 0
            held.append((i, at, p))
            at += len(p)
            size += len(p)
    if held:
        _sample(v, held, keys, seed, out)
    return [None if o is None else (np.concatenate(o) if o else np.empty(0, np.int32)) for o in out]


def _sample(v: Vocabulary, held: list[tuple[int, int, np.ndarray]], keys: list[int], seed: int, out: list) -> None:
    points = np.concatenate([h[2] for h in held])
    length = np.array([len(h[2]) for h in held])
    part_first = np.cumsum(length) - length
    mark = points == MARK
    single = ~np.isin(points, v.inner)
    new = np.empty(len(points), bool)
    new[0] = True
    new[1:] = (mark[1:] & ~mark[:-1]) | single[1:] | single[:-1]
    new[part_first] = True
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(points)))
    own = np.searchsorted(part_first, first, "right") - 1
    row_seed = mix(np.array([(keys[h[0]] ^ (seed * 0x5851F42D4C957F2D)) & (2**64 - 1) for h in held], np.uint64))
    base = np.array([h[1] for h in held]) - part_first  # character of the whole text = place here + base
    ids = np.full(len(points), -2, np.int64)
    for k in np.flatnonzero(size > LONG):
        ends = (np.arange(first[k] + 1, first[k] + size[k] + 1) + base[own[k]]).astype(np.uint64)
        begin, ident = sample_long(v, points[first[k] : first[k] + size[k]], (mix(row_seed[own[k]] + ends * _BASE) >> np.uint64(32)).astype(np.int64))
        ids[first[k] + begin] = ident
    short = size <= LONG
    first, size, own = first[short], size[short], own[short]
    if len(first):
        _sample_short(v, points, first, size, row_seed[own], base[own], ids)
    at = np.flatnonzero(ids > -2)
    got = ids[at]
    by_bytes = np.flatnonzero(got < 0)
    if len(by_bytes):
        spelled = _utf8(points[at[by_bytes]])
        n = np.ones(len(got), np.int64)
        n[by_bytes] = [len(s) for s in spelled]
        at = np.repeat(at, n)
        place = np.repeat(np.cumsum(n)[by_bytes] - n[by_bytes], n[by_bytes])
        step = np.arange(len(place)) - np.repeat(np.cumsum(n[by_bytes]) - n[by_bytes], n[by_bytes])
        got = np.repeat(got, n)
        got[place + step] = np.frombuffer(b"".join(spelled), np.uint8).astype(np.int64) + v.first_byte
    cut = np.searchsorted(at, np.append(part_first, len(points)))
    got = got.astype(np.int32)
    for k, h in enumerate(held):
        out[h[0]].append(got[cut[k] : cut[k + 1]])


def _sample_short(v: Vocabulary, points: np.ndarray, first: np.ndarray, size: np.ndarray, row_seed: np.ndarray, base: np.ndarray, ids: np.ndarray) -> None:
    """Sample all words of at most ``LONG`` characters, distinct ones filtered once; an id is put where its piece begins."""
    total, inverse = _sums(points), _powers(len(points) + 1)[1]
    name = mix(((total[first + size] - total[first]) * inverse[first]) ^ (size.astype(np.uint64) << np.uint64(40)))
    _, rep, word = np.unique(name, return_index=True, return_inverse=True)
    u_size = size[rep]
    u_first = np.cumsum(u_size) - u_size
    within = np.arange(u_size.sum()) - np.repeat(u_first, u_size)
    begin, ident, threshold = filter_words(v, points[np.repeat(first[rep], u_size) + within], u_first, u_size)

    at_end, floor, shift = u_first[word] + u_size[word], u_first[word], first - u_first[word]
    while len(at_end):
        text_end = (at_end + shift + base).astype(np.uint64)
        draw = (mix(row_seed + text_end * _BASE) >> np.uint64(32)).astype(np.int64)
        edge = np.searchsorted(threshold, at_end.astype(np.int64) * 2**32 + draw)
        b = begin[edge]
        ids[b + shift] = ident[edge]
        more = b > floor
        at_end, floor, shift, row_seed, base = b[more], floor[more], shift[more], row_seed[more], base[more]


def decode_ids(v: Vocabulary, ids: np.ndarray) -> bytes:
    """The bytes of the text; the first mark is dropped."""
    return b"".join([v.raw[i] for i in ids.tolist()])[1:]


def encode(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text", seed: int = 0, sharpness: float = 1.0) -> DataFrame:
    """``(doc_id, text_hash, pieces)`` of every row; ``text_hash`` is XXH64 of the text, to hold a decoded one against."""
    held = docs.sparkSession.sparkContext.broadcast(load(model, sharpness))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = encode_texts(held.value, batch.column(2).to_pylist(), [x or 0 for x in batch.column(0).to_pylist()], seed)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "text_hash", "pieces"])

    text = F.col(text_col).cast("binary")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(run, "doc_id long, text_hash long, pieces array<int>")


def decode(encoded: DataFrame, model: str = MODEL, pieces_col: str = "pieces") -> DataFrame:
    """The columns of ``encoded`` with ``text``, decoded."""
    held = encoded.sparkSession.sparkContext.broadcast(load(model))
    at = encoded.columns.index(pieces_col)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(at)
            flat, cut, valid = np.asarray(col.values), np.asarray(col.offsets), col.is_valid().to_pylist()
            texts = [decode_ids(held.value, flat[cut[i] : cut[i + 1]]) if ok else None for i, ok in enumerate(valid)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, "text"])

    from pyspark.sql.types import BinaryType, StructField, StructType

    out = encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField("text", BinaryType())]))
    return out.withColumn("text", F.col("text").cast("string"))
