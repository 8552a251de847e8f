"""SentencePiece encoding with sampled segmentations, and lossless decoding.

A text is read as SentencePiece reads it: a space before it, spaces as U+2581.
Its piece lattice has an edge for every vocabulary piece at every place and byte
edges for characters that no piece holds.  Forward filtering sums the weights of
all segmentations up to each place; backward sampling draws the pieces from the
end.  No piece goes on after a space or a line break inside it, so the lattice
falls into units (spaces with the word after them) that are filtered once per
block and sampled on their own, which gives the same distribution.

The model ranks its pieces but gives no probabilities, so a piece's weight
follows Zipf's law by its rank; ``sharpness`` is the exponent.

Draw ``s`` of unit ``u`` of a row is a hash of the row's seed, ``u`` and ``s``,
so segmentations do not depend on partitions, batches or reruns.

Defined results: null text gives null pieces and back; empty text gives no
pieces; U+2581 itself, and every character without a piece, is written in bytes,
so decoding returns the very text; control strings in a text are ordinary text;
rows with equal ids and texts get equal pieces; an empty table gives an empty
result; further columns may have any name.  Memory is bounded by a block of
units and the pieces of one Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from likeness.llm.hashing import text_bytes
from likeness.llm.tables import free_name

SPACE = "▁"
#: Stands for U+2581 in a text, which no piece may match.
_LITERAL = 0x110000
SEED = 1
SHARPNESS = 1.0
#: Units filtered and sampled together, and rows encoded or decoded together.
BLOCK, ROWS = 1 << 16, 256
_HASH = np.uint64(0x9E3779B97F4A7C15)
_SLOT_BITS = 20


def _mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finisher."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _slot(h: np.ndarray, number: int) -> np.ndarray:
    """The slot of a hash, by one of many hash functions."""
    factor = 0xD6E8FEB86659FD93 * (2 * number + 1) & (2**64 - 1)
    return ((h * np.uint64(factor)) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


class Vocabulary:
    """The pieces of a model: by hash for the lattice, as bytes for decoding."""

    def __init__(self, path: str, sharpness: float):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.bytes = [p.replace(SPACE, " ").encode() for p in pieces]
        self.byte_ids = np.zeros(256, np.int32)
        plain = []
        for i, piece in enumerate(pieces):
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_ids[value] = i
                self.bytes[i] = bytes([value])
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes[i] = b""
            else:
                plain.append(i)
                if SPACE in piece.lstrip(SPACE) or "\n" in piece[:-1] or "\n" in piece[1:]:
                    raise ValueError(f"Piece {i} goes on after a space or line break")
        self.weight = np.zeros(len(pieces))
        ranked = sorted(plain, key=lambda i: (-model.get_score(i), i))
        # White-space pieces carry a sentinel score; their id says as little, so they come last.
        self.weight[ranked] = -sharpness * np.log(np.arange(len(ranked)) + 2.0)
        #: Weight of one byte: like the rarest piece.
        self.byte_weight = float(self.weight[ranked].min())
        self.spelled = pa.array(self.bytes, pa.large_binary())
        self._index(pieces, plain)

    def _index(self, pieces: list[str], plain: list[int]) -> None:
        """A hash table of all beginnings of pieces: the piece, if it is one, and if any goes on."""
        entries: dict[int, list[int]] = {}
        for i in plain:
            h = 0
            for n, c in enumerate(map(ord, pieces[i]), 1):
                h = (h * int(_HASH) + c + 1) & (2**64 - 1)
                entry = entries.setdefault(h, [-1, 0])
                if n < len(pieces[i]):
                    entry[1] = 1
                else:
                    entry[0] = i
        self.longest = max(len(pieces[i]) for i in plain)
        self.hashes = np.array([*entries, 0], np.uint64)
        self.piece = np.array([e[0] for e in entries.values()] + [-1], np.int32)
        self.goes_on = np.array([e[1] for e in entries.values()] + [0], bool)
        # Two slots for an entry: the few that find the first one taken use the second.
        self.slots = np.full((2, 1 << _SLOT_BITS), len(entries), np.int32)
        placed = _slot(self.hashes[:-1], 0)
        self.slots[0][placed] = np.arange(len(entries))
        rest = np.flatnonzero(self.slots[0][placed] != np.arange(len(entries)))
        self.second = next(
            n
            for n in range(1, 1000)
            if len(np.unique(_slot(self.hashes[rest], n))) == len(rest)
        )
        self.slots[1][_slot(self.hashes[rest], self.second)] = rest

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """The table's entry of every hash, or the last entry, which is no piece and ends all."""
        at = self.slots[0][_slot(h, 0)]
        missed = np.flatnonzero(self.hashes[at] != h)
        other = self.slots[1][_slot(h[missed], self.second)]
        at[missed] = np.where(self.hashes[other] == h[missed], other, len(self.hashes) - 1)
        return at


@cache
def vocabulary(path: str, sharpness: float = SHARPNESS) -> Vocabulary:
    """The vocabulary of a model file, read once in each worker."""
    return Vocabulary(path, sharpness)


class Lattice:
    """Filtered lattices of different units, laid end to end.

    Node ``first[u] + n`` stands after ``n`` characters of unit ``u``.  The edges
    into a node are consecutive from ``into`` on, with their cumulative
    probability in ``share``; that of a node's last edge is one.
    """

    def __init__(self, units: pa.Array, vocab: Vocabulary):
        sizes = pc.utf8_length(units).to_numpy().astype(np.int64)
        data, _ = text_bytes(units)
        codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4").astype(np.uint64)
        literal = codes == ord(SPACE)
        codes[codes == 32] = ord(SPACE)
        codes[literal] = _LITERAL
        self.sizes = sizes
        self.first = np.r_[0, np.cumsum(sizes + 1)[:-1]].astype(np.int32)
        before = np.repeat(np.cumsum(sizes) - sizes, sizes)
        offset = (np.arange(len(codes)) - before).astype(np.int32)
        left = np.repeat(sizes.astype(np.int32), sizes) - offset  # characters from here to the unit's end
        node = np.repeat(self.first, sizes) + offset
        froms, spans, tokens, weights = [], [], [], []
        active, h = np.arange(len(codes)), np.zeros(len(codes), np.uint64)
        for n in range(1, vocab.longest + 1):
            h = h * _HASH + codes[active + (n - 1)] + np.uint64(1)
            entry = vocab.lookup(h)
            ids = vocab.piece[entry]
            hit = ids >= 0
            found = ids[hit]
            froms.append(node[active[hit]])
            spans.append(np.full(len(found), n, np.int32))
            tokens.append(found)
            weights.append(vocab.weight[found])
            if n == 1 and not hit.all():
                other = active[~hit]
                points = np.where(codes[other] == _LITERAL, np.uint64(ord(SPACE)), codes[other])
                width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
                froms.append(node[other])
                spans.append(np.ones(len(other), np.int32))
                tokens.append(-1 - points.astype(np.int32))
                weights.append(width * vocab.byte_weight)
            more = vocab.goes_on[entry] & (left[active] > n)
            active, h = active[more], h[more]
            if not len(active):
                break
        # Long pieces first: they are the likely ones, so draws mostly end at a node's first edge.
        start, span = np.concatenate(froms[::-1]), np.concatenate(spans[::-1])
        end = start + span
        order = np.argsort(end, kind="stable")  # merges the runs, one for each length
        start, end = start[order], end[order]
        token, weight = np.concatenate(tokens[::-1])[order], np.concatenate(weights[::-1])[order]

        total = np.zeros(len(codes) + len(units))
        place = np.zeros(len(total), np.int32)  # characters before each node
        place[node + 1] = offset + 1
        # Forward filtering, all units at once, from place to place.  A node's edges stay together.
        at = place[end]
        small = at.astype(np.uint16) if len(at) and at.max() < 1 << 16 else at
        order = np.argsort(small, kind="stable")
        f_start, f_end, f_weight = start[order], end[order], weight[order]
        steps = np.r_[0, np.cumsum(np.bincount(at)[1:])] if len(at) else [0]
        for a, b in zip(steps[:-1], steps[1:], strict=True):
            score = total[f_start[a:b]] + f_weight[a:b]
            into = f_end[a:b]
            cuts = np.r_[0, np.flatnonzero(into[1:] != into[:-1]) + 1]
            most = np.maximum.reduceat(score, cuts)
            wide = np.repeat(most, np.diff(np.r_[cuts, b - a]))
            total[into[cuts]] = most + np.log(np.add.reduceat(np.exp(score - wide), cuts))
        chance = np.exp(total[start] + weight - total[end])
        cuts = np.r_[0, np.flatnonzero(end[1:] != end[:-1]) + 1]
        sums = np.cumsum(chance)
        ahead = np.repeat((sums - chance)[cuts], np.diff(np.r_[cuts, len(end)]))
        share = np.minimum(sums - ahead, 1.0)
        share[np.r_[cuts[1:] - 1, len(end) - 1]] = 1.0  # the last edge takes what rounding left
        self.share, self.start, self.token = share.astype(np.float32), start, token
        self.into = np.zeros(len(total), np.int32)
        self.into[end[cuts]] = cuts

    def sample(self, unit: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of every occurrence (unit number and seed), end to end, and their counts."""
        begins = self.first[unit]
        ends = begins + self.sizes[unit].astype(np.int32)
        who, node = np.arange(len(unit)), ends
        drawn: list[tuple[np.ndarray, np.ndarray]] = []
        step = 0
        while len(who):
            bits = _mixed(seed[who] + np.uint64(step * int(_HASH) & (2**64 - 1)))
            u = (bits >> np.uint64(11)).astype(float) * 2.0**-53
            edge = self.into[node]
            passed = np.flatnonzero(self.share[edge] <= u)
            while len(passed):
                edge[passed] += 1
                passed = passed[self.share[edge[passed]] <= u[passed]]
            drawn.append((who, self.token[edge]))
            node = self.start[edge]
            going = node > begins[who]
            who, node = who[going], node[going]
            step += 1
        counts = np.zeros(len(unit), np.int64)
        for row, _ in drawn:
            counts[row] += 1
        last = np.cumsum(counts) - 1
        out = np.zeros(int(counts.sum()), np.int32)
        for step, (row, token) in enumerate(drawn):
            out[last[row] - step] = token
        return out, counts


def _written(tokens: np.ndarray, counts: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Byte pieces in place of characters without a piece."""
    plain = np.flatnonzero(tokens < 0)
    if not len(plain):
        return tokens.astype(np.int32), counts
    spelled = [chr(-1 - t).encode("utf-8", "surrogatepass") for t in tokens[plain].tolist()]
    width = np.ones(len(tokens), np.int64)
    width[plain] = [len(s) for s in spelled]
    out = np.repeat(tokens, width).astype(np.int32)
    ends = np.cumsum(width)
    at = np.concatenate([np.arange(ends[i] - width[i], ends[i]) for i in plain])
    out[at] = vocab.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
    owner = np.repeat(np.arange(len(counts)), counts)
    return out, np.bincount(owner, weights=width, minlength=len(counts)).astype(np.int64)


def unit_starts(data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Where units start: with each row, run of spaces and line break, and after line breaks."""
    space, line = data == 32, data == 10
    starts = np.zeros(len(data) + 1, bool)
    starts[:-1] |= line
    starts[1:] |= line
    starts[:-1] |= space
    starts[1:-1] &= ~(space[1:] & space[:-1])
    starts[rows] = True
    return np.flatnonzero(starts[:-1])


def sample_block(
    units: pa.Array, seeds: np.ndarray, vocab: Vocabulary
) -> tuple[np.ndarray, np.ndarray]:
    """Sampled piece ids of units (one seed each), end to end, and their counts."""
    different = units.dictionary_encode()
    lattice = Lattice(different.dictionary, vocab)
    return _written(*lattice.sample(different.indices.to_numpy(), seeds), vocab)


def encode_batch(texts: pa.Array, seeds: np.ndarray, vocab: Vocabulary, block: int = BLOCK) -> pa.Array:
    """A list of piece ids for every text (null for null)."""
    full = pc.and_(pc.is_valid(texts), pc.greater(pc.binary_length(texts), 0)).fill_null(False)
    spaced = pc.binary_join_element_wise(" ", texts.filter(full), "")
    data, rows = text_bytes(spaced)
    starts = unit_starts(data, rows)
    firsts = np.searchsorted(starts, rows)  # first unit of each row, and one past the last
    row = np.repeat(np.flatnonzero(full.to_numpy(zero_copy_only=False)), np.diff(firsts))
    place = np.arange(len(starts)) - np.repeat(firsts[:-1], np.diff(firsts))
    offsets = pa.py_buffer(np.r_[starts, len(data)].astype(np.int64))
    units = pa.Array.from_buffers(
        pa.large_string(), len(starts), [None, offsets, pa.py_buffer(np.ascontiguousarray(data))]
    )
    made, per_row = [], np.zeros(len(texts), np.int64)
    for a in range(0, len(starts), block):
        part = slice(a, a + block)
        seed = _mixed(seeds[row[part]] ^ _mixed(place[part].astype(np.uint64) + _HASH))
        tokens, counts = sample_block(units[part], seed, vocab)
        made.append(tokens)
        per_row += np.bincount(row[part], weights=counts, minlength=len(texts)).astype(np.int64)
    values = np.concatenate(made) if made else np.zeros(0, np.int32)
    ends = np.r_[0, np.cumsum(per_row)].astype(np.int32)
    null = pc.is_null(texts) if texts.null_count else None
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()), mask=null)


def _digests(texts: pa.Array) -> pa.Array:
    """The lower-case hex SHA-256 of every text (null for null)."""
    made = [t if t is None else sha256(t.encode()).hexdigest() for t in texts.to_pylist()]
    return pa.array(made, pa.string())


def _encoder(path: str, sharpness: float, text: str, seed: str, out: str, digest: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, sharpness)
        for batch in batches:
            kept = [n for n in batch.schema.names if n != seed]
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                seeds = part.column(seed).to_numpy().view(np.uint64)
                made = encode_batch(part.column(text), seeds, vocab)
                columns, names = [*(part.column(n) for n in kept), made], [*kept, out]
                if digest:
                    columns.append(_digests(decode_batch(made, vocab)))
                    names.append(digest)
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def encode(
    docs: DataFrame,
    model_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    out: str = "pieces",
    seed: int = SEED,
    sharpness: float = SHARPNESS,
    decoded_digest: str | None = None,
) -> DataFrame:
    """``docs`` with the sampled piece ids of each text in ``out``.

    ``model_file`` is a path on every executor; it is read there.  With
    ``decoded_digest``, the pieces are decoded again where they were made and a
    column of that name has the SHA-256 of the decoded text.
    """
    row_seed = free_name(docs, "row_seed")
    seeded = docs.withColumn(row_seed, F.xxhash64(F.lit(seed), F.col(id_col)))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    made = f"{fields}, {out} array<int>" + (f", {decoded_digest} string" if decoded_digest else "")
    return seeded.mapInArrow(
        _encoder(model_file, sharpness, text_col, row_seed, out, decoded_digest), made
    )


def decode_batch(pieces: pa.Array, vocab: Vocabulary) -> pa.Array:
    """The text of every list of piece ids (null for null)."""
    ends = pieces.offsets.to_numpy()
    spelled = vocab.spelled.take(pieces.values.slice(ends[0], ends[-1] - ends[0]))
    _, offsets, data = spelled.buffers()
    at = np.frombuffer(offsets, np.int64)[: len(spelled) + 1][ends - ends[0]]
    whole = pa.Array.from_buffers(
        pa.large_binary(), len(pieces), [None, pa.py_buffer(np.ascontiguousarray(at)), data]
    )
    # Without the space that was put before the text.
    texts = pc.utf8_slice_codeunits(whole.cast(pa.large_string()), 1)
    return pc.if_else(pc.is_valid(pieces), texts, None) if pieces.null_count else texts


def decode(pieces: Column, model_file: str) -> Column:
    """The text that a list of piece ids was made from."""

    @F.arrow_udf("string")
    def run(rows: pa.Array) -> pa.Array:
        vocab = vocabulary(model_file)
        parts = [decode_batch(rows[a : a + ROWS], vocab) for a in range(0, len(rows), ROWS)]
        return pa.concat_arrays([pa.array([], pa.string()), *(p.cast(pa.string()) for p in parts)])

    return run(pieces)
