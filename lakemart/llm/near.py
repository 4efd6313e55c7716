"""Near-duplicate search on signatures: banding, verification, components.

Shared by documents and lines. A *node* is a distinct text, known by a 64-bit
hash; its signature is a row of 16-bit registers. Bands use the first of them.
Estimates use four bits of all of them: registers of 16 bits that agree always
agree in these, and one pair of differing ones in 16 does by chance.

1. Banding by a packed exchange, some bands at a time. A task sends the band values
   of a block's nodes, each with a sketch of one bit a register, to the owners of
   the values' ranges, packed; an owner unpacks the values that several nodes share
   and keeps the nodes to which a sketch of their band comes near enough (all of a
   band too large to compare). A copy held by very many rows is one node. Of bands
   that hold the same nodes one is kept.
2. Within a band value each node's best partner by signature is looked up, and
   the best of its bands is checked exactly. Components follow from the links.
3. Nodes whose band has several components go on to their next partners in other
   components, in order of agreement, once more. Larger bands are dealt into
   parts at random as long as most of the tests that brings find links.
4. What is left is searched to its end, some bands at a time: the texts go with the nodes of
   a band (of a larger one: blocks of the nodes outside its largest component meet
   every part of it), so pairs are tested where they meet and never written out.
   A pair that meets in several bands is tested in one of them, and pairs that
   links of the task have already joined are not. Every pair of a band that
   reaches the cut has then been tested or is within a component.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import dropped, shuffles_freed, staged
from lakemart.llm.components import components

#: Nodes banded together in a task before their entries are sent.
BLOCK_NODES = 1 << 15
#: Exchanges that the bands are sent in, one after the other: what one holds on disk.
SLICES = 2
#: Registers of which a sketch holds the lowest bit, and by how many standard
#: deviations nodes at the cut may agree in fewer bits than they are expected to.
SKETCH, SLACK = 64, 2
#: Nodes of a band whose sketches are all compared, and nodes that those of a band
#: of more than ``PART_NODES`` are compared with before.
LARGEST, FIRST = 1 << 14, 1 << 8
#: Parts, by their bands, of what is left to search, one after the other.
REST = 4
#: Bands of up to this many nodes are searched many at a time.
TINY = 12
#: Partners a node goes on to in a round.
PARTNERS = 2
#: Nodes of a band compared with each other at once; larger bands are dealt
#: into such parts by another hash in every round, and then meet part by part.
PART_NODES = 1 << 10


_PAIR = ["a", "c", "ra", "rc", "agree"]
#: A node's place in a band: the agreement and the node of its last partner.
_WORK = ["h", "part", "node", "role", "score", "last"]
#: Roles of a band's rows: all of the band's nodes; a deal of a larger band; a
#: block's nodes, which ask, and a part's nodes, which they ask for.
WHOLE, DEALT, ASKS, ASKED = range(4)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _joined(column: pa.Array) -> np.ndarray:
    """The bytes of the values of a binary column without nulls."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]]


def signatures(column: pa.Array) -> np.ndarray:
    """The registers (nodes, m) of a binary column of equal lengths."""
    return _joined(column).view(np.uint16).reshape(len(column), -1)


def _binary(rows: np.ndarray) -> pa.Array:
    """A binary column of the rows of a matrix."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    ends = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])


def thinned(sig: np.ndarray) -> pa.Array:
    """Signatures of four bits a register, two in a byte, which go with each row
    of a band (an odd last register goes with an empty one)."""
    sig = (sig & np.uint16(15)).astype(np.uint8)
    sig = np.pad(sig, ((0, 0), (0, sig.shape[1] % 2)))
    return _binary(sig[:, ::2] << 4 | sig[:, 1::2])


def _thinned(rows: DataFrame) -> DataFrame:
    """Rows (key, sig) with thinned signatures."""

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), thinned(signatures(batch.column(1)))], ["key", "sig"])

    return rows.select("key", "sig").mapInArrow(thin, "key bigint, sig binary")


def _words(column: pa.Array) -> tuple[np.ndarray, int]:
    """Thinned signatures (nodes, words) of 16 registers a word, and the number of registers."""
    both = _joined(column).reshape(len(column), -1)
    return np.pad(both, ((0, 0), (0, -both.shape[1] % 8))).view(np.uint64), 2 * both.shape[1]


def _band_values(sig: np.ndarray, bands: range, rows: int) -> np.ndarray:
    value = np.zeros((len(sig), len(bands)), np.uint64) + np.arange(bands.start + 1, bands.stop + 1, dtype=np.uint64)
    parts = sig[:, bands.start * rows:bands.stop * rows].reshape(len(sig), len(bands), rows)
    words = np.ascontiguousarray(np.pad(parts, ((0, 0), (0, 0), (0, -rows % 4)))).view(np.uint64)   # four registers each
    for w in range(words.shape[2]):
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + words[:, :, w])
    return value


def _slices(bands: int, slices: int) -> list[range]:
    step = -(-bands // slices)
    return [range(at, min(bands, at + step)) for at in range(0, bands, step)]


def slice_columns(bands: int, slices: int) -> list[str]:
    """Names of the columns that :func:`band_columns` gives."""
    return [f"values_{i}" for i in range(len(_slices(bands, slices)))]


def band_columns(sig: np.ndarray, bands: int, rows: int, slices: int) -> list[pa.Array]:
    """Values of 32 bits of the bands of each slice."""
    return [_binary((_band_values(sig, some, rows) >> np.uint64(32)).astype(np.uint32))
            for some in _slices(bands, slices)]


def _sketches(sig: np.ndarray, size: int) -> np.ndarray:
    """The lowest bits of the first ``size`` registers of each node, in words (nodes, words)."""
    bits = np.packbits((sig[:, :size] & 1).astype(np.uint8), axis=1)
    return np.pad(bits, ((0, 0), (0, -bits.shape[1] % 8))).view(np.uint64)


def _bits_apart(cut: float, size: int) -> int:
    """In how many bits the sketches of nodes may differ that agree in a share
    ``cut`` of their registers of four bits; at the threshold of a search, which
    lies three deviations above its cut, they hardly ever differ in more."""
    alike = (1 + max(0.0, (cut - 1 / 16) / (15 / 16))) / 2
    return size - int(size * alike - SLACK * (size * alike * (1 - alike)) ** 0.5)


def _bits_differ(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many bits each sketch of ``x`` (.., p, words) differs from each of ``y`` (.., q, words)."""
    out = np.zeros((*x.shape[:-1], y.shape[-2]), np.uint8)
    for w in range(x.shape[-1]):
        out += np.bitwise_count(x[..., :, None, w] ^ y[..., None, :, w])
    return out


def _with_partner(h: np.ndarray, sketch: np.ndarray, apart: int, largest: int) -> np.ndarray:
    """Which nodes, sorted by band value, have another one in their band whose
    sketch differs in up to ``apart`` bits; all of bands above ``largest`` nodes."""
    if not len(h):
        return np.zeros(0, bool)
    cuts = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1], [True])))
    size = np.diff(cuts)
    stay = np.repeat(size > largest, size)
    for n in range(2, TINY + 1):
        starts = cuts[:-1][size == n]
        step = (1 << 20) // (n * n)
        for a in range(0, len(starts), step):
            at = starts[a:a + step, None] + np.arange(n)
            own = sketch[at]
            stay[at] |= (_bits_differ(own, own) <= apart).sum(axis=2) > 1
    some = (size > TINY) & (size <= largest)
    for a, n in zip(cuts[:-1][some], size[some], strict=True):
        own, found = sketch[a:a + n], stay[a:a + n]
        if n > PART_NODES:          # most nodes of copies have a partner among any few
            near = _bits_differ(own, own[:FIRST]) <= apart
            near[np.arange(FIRST), np.arange(FIRST)] = False
            found |= near.any(axis=1)
            found[:FIRST] |= near.any(axis=0)
        rest = np.flatnonzero(~found)
        step = max(1, (1 << 20) // n)
        for at in range(0, len(rest), step):
            ask = rest[at:at + step]
            found[ask] = (_bits_differ(own[ask], own) <= apart).sum(axis=1) > 1
    return stay


def _sets(h: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Band value, hash and nodes of each set of nodes, from nodes sorted by band value.
    Equal sets have equal hashes; a band of more than ``PART_NODES`` nodes gives
    several sets, whose hashes are its own."""
    at = np.arange(len(h))
    new = np.append(True, h[1:] != h[:-1])[:len(h)]
    start = np.maximum.accumulate(np.where(new, at, 0))
    cuts = np.append(np.flatnonzero((at - start) % PART_NODES == 0), len(h))
    if not len(h):
        return h, node, []
    first = cuts[:-1]
    of = np.add.reduceat(mix(node.astype(np.uint64)), first)
    size = np.diff(np.append(np.flatnonzero(new), len(h)))
    large = np.repeat(size > PART_NODES, size)[first]
    of[large] += mix(h[first][large].astype(np.uint64))
    return h[first], mix(of).astype(np.int64), np.split(node, cuts[1:-1])


def band_members(signed: DataFrame, bands: int, rows: int, cut: float, **options) -> list[DataFrame]:
    """Rows ``(h, node)`` of each table of :func:`band_sets`."""
    return [sets.select("h", F.explode("nodes").alias("node"))
            for sets in band_sets(signed, bands, rows, cut, **options)]


def band_sets(signed: DataFrame, bands: int, rows: int, cut: float, *, slices: int = SLICES,
              sketch: int = SKETCH) -> list[DataFrame]:
    """Staged tables of rows ``(h, of, nodes)``: the nodes of every band value that several
    nodes share, without those whose sketch comes near no other one there, and a hash
    of the set of nodes (of each of the sets that a large band gives). ``signed``
    has rows (key, sig), or also (:func:`band_columns`) with :func:`thinned` signatures
    of as many registers as a sketch; a key may come up again."""
    owners = int(signed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed_values = slice_columns(bands, slices)[0] in signed.columns
    size = sketch if packed_values else min(sketch, bands * rows)
    apart = _bits_apart(cut, size)
    # an owner's values differ in their lower half as well
    entry = np.dtype([("key", np.int64), ("sketch", np.uint64, (-(-size // 64),)), ("h", np.uint32)])

    def values_of(part: pa.RecordBatch, first: np.ndarray, some: range) -> tuple[np.ndarray, np.ndarray]:
        """Band values (nodes, bands) and sketches of the nodes of rows ``first``."""
        if not packed_values:
            sig = signatures(part.column(1))[first]
            return _band_values(sig, some, rows), _sketches(sig, size)
        value = _joined(part.column(2)).view(np.uint32).reshape(part.num_rows, -1)[first].astype(np.uint64)
        both = _joined(part.column(1)).reshape(part.num_rows, -1)[first]
        sig = np.stack((both >> 4, both), axis=2).reshape(len(both), -1)
        return mix(value | np.arange(some.start + 1, some.stop + 1, dtype=np.uint64) << np.uint64(32)), _sketches(sig, size)

    def members(number: int, some: range) -> DataFrame:
        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK_NODES):
                    part = batch.slice(at, BLOCK_NODES)
                    key, first = np.unique(part.column(0).to_numpy(), return_index=True)
                    value, own = values_of(part, first, some)
                    packed = np.empty(value.shape, entry)
                    packed["key"], packed["sketch"] = key[:, None], own[:, None]
                    packed["h"] = value.astype(np.uint32)
                    owner = ((value >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).ravel()
                    order = np.argsort(owner.astype(np.min_scalar_type(owners)), kind="stable")
                    packed, owner = packed.ravel()[order], owner[order]
                    cuts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1], [True])))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(owner[cuts[:-1]], pa.int32()),
                         pa.array([packed[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)],
                                  pa.binary())], ["owner", "entries"])

        def shared(owner, frame):
            import pandas as pd

            packed = np.frombuffer(b"".join(frame["entries"]), entry)
            h = np.sort(packed["h"].astype(np.uint64) << np.uint64(32) | np.arange(len(packed), dtype=np.uint64))
            order, h = (h & np.uint64(0xFFFFFFFF)).astype(np.int64), h >> np.uint64(32)
            same = h[1:] == h[:-1]
            packed = packed[order[np.append(same, False) | np.append(False, same)]]
            key, h = packed["key"].copy(), packed["h"].copy()
            order = np.lexsort((key, h))
            key, h = key[order], h[order]
            new = np.append(True, (key[1:] != key[:-1]) | (h[1:] != h[:-1]))[:len(h)]
            key, h, own = key[new], h[new], packed["sketch"][order[new]]
            stay = _with_partner(h, own, apart, LARGEST)
            h, of, nodes = _sets(h[stay].astype(np.int64) + (number * owners + int(owner[0]) << 32), key[stay])
            return pd.DataFrame({"h": h, "of": of, "nodes": pd.Series(nodes, dtype=object)})

        sent = signed.select("key", "sig", *([slice_columns(bands, slices)[number]] if packed_values else [])) \
            .mapInArrow(send, "owner int, entries binary")
        return staged(sent.groupBy("owner").applyInPandas(shared, "h bigint, of bigint, nodes array<bigint>"), "band-members")

    found = []
    for number, some in enumerate(_slices(bands, slices)):
        found.append(members(number, some))
        shuffles_freed(signed.sparkSession)
    return found


def _verified(pairs: DataFrame, texts: DataFrame, same: Callable[[], Callable[[str, str], bool]]) -> DataFrame:
    """The pairs (a, c, ra, rc) whose texts pass; ``same()`` makes the test of a task."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = same()
        for batch in batches:
            ok = pa.array([test(x.as_py(), y.as_py()) for x, y in
                           zip(batch.column(4), batch.column(5), strict=True)], pa.bool_())
            yield batch.select([0, 1, 2, 3]).filter(ok)

    a = texts.select(F.col("key").alias("a"), F.col("text").alias("ta"))
    c = texts.select(F.col("key").alias("c"), F.col("text").alias("tc"))
    return pairs.join(a, "a").join(c, "c").select("a", "c", "ra", "rc", "ta", "tc") \
        .mapInArrow(check, "a bigint, c bigint, ra bigint, rc bigint")


def _agreeing(x: np.ndarray, y: np.ndarray, registers: int) -> np.ndarray:
    """In how many registers each of ``x`` (.., p, words) agrees with each of ``y`` (.., q, words)."""
    out = np.full((*x.shape[:-1], y.shape[-2]), registers, np.int16)
    for w in range(x.shape[-1]):
        differ = x[..., :, None, w] ^ y[..., None, :, w]
        differ |= differ >> np.uint64(1)
        differ |= differ >> np.uint64(2)
        out -= np.bitwise_count(differ & np.uint64(0x1111111111111111))
    return out


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole groups (h, part), the first two columns, of sorted rows."""
    held = None
    for batch in batches:                     # the last group may go on
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        h, part = held.column(0).to_numpy(), held.column(1).to_numpy()
        last = int(np.flatnonzero((h == h[-1]) & (part == part[-1]))[0])
        if last:
            yield held.slice(0, last)
            held = held.slice(last)
    if held is not None:
        yield held


def _next_partners(rows: DataFrame, cut: float, most: int, first: bool) -> DataFrame:
    """Two kinds of rows, from rows ``(h, part, node, role, score, last, root, sig)``:

    Pairs (a, c, ra, rc, agree): for each node that asks, the next ``most``
    nodes of its part in other components whose signatures agree in at least a
    share ``cut`` of the registers, the most agreeing (then smallest) first,
    after the place (score, last). Links go both ways, so all ask but the nodes
    of the part's largest component; when it is the ``first`` time, all.

    Places (h, part, node, role, score, last) of the nodes that have something
    left, not moved the ``first`` time; none of a deal, whose places start anew.
    """

    def pick(agree, least, fit, score, last, others):
        """Indices (.., p, most) of partners, their agreement, and how many there were."""
        fit = fit & (agree >= least)
        fit &= (agree < score[..., None]) | (agree == score[..., None]) & (others[..., None, :] > last[..., None])
        agree = np.where(fit, agree, np.int16(-1))
        order = np.argsort(-agree, axis=-1, kind="stable")[..., :most]
        return order, np.take_along_axis(agree, order, axis=-1), fit.sum(axis=-1)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(table: pa.Table) -> pa.RecordBatch:
            h, part, node, role, score, last, root = (table.column(i).to_numpy() for i in range(7))
            sig, registers = _words(table.column(7).combine_chunks())
            least = int(np.ceil(cut * registers - 1e-9))
            cuts = np.flatnonzero(np.concatenate(
                ([True], (h[1:] != h[:-1]) | (part[1:] != part[:-1]), [True])))
            size = np.diff(cuts)
            # groups of one component have nothing to find
            size[np.minimum.reduceat(root, cuts[:-1]) == np.maximum.reduceat(root, cuts[:-1])] = 1
            pairs, score, last = [], score.copy(), last.copy()
            stay = np.zeros(len(h), bool)

            def take(at: np.ndarray, others: np.ndarray, ask: np.ndarray) -> None:
                """Search for rows ``at`` (.., p) among ``others`` (.., q), sorted by node."""
                fit = ask[..., None] & (root[at][..., None] != root[others][..., None, :])
                order, agree, fits = pick(_agreeing(sig[at], sig[others], registers), least, fit, score[at], last[at], node[others])
                good = agree >= least
                if good.any():
                    to = np.take_along_axis(np.broadcast_to(others[..., None, :], (*at.shape, others.shape[-1])),
                                            order, axis=-1)
                    own = np.broadcast_to(at[..., None], to.shape)[good]
                    to = to[good]
                    pairs.append(np.stack((node[own], node[to], root[own], root[to], agree[good]), axis=1))
                on = ask & (fits > (0 if first else most))
                stay[at] = on | ~ask & on.any(axis=-1, keepdims=True)   # who does not ask waits for those who do
                if not first:
                    j = order[..., -1]
                    last[at[on]] = np.take_along_axis(node[others], j, axis=-1)[on]
                    score[at[on]] = agree[..., -1][on]

            tiny = (size <= TINY) & (np.maximum.reduceat(role, cuts[:-1]) < ASKS)
            for n in range(2, TINY + 1):
                starts = cuts[:-1][tiny & (size == n)]
                step = max(1, (1 << 19) // (n * n))
                for a in range(0, len(starts), step):
                    at = starts[a:a + step, None] + np.arange(n)
                    at = np.take_along_axis(at, np.argsort(node[at], axis=1), axis=1)
                    of = root[at]
                    count = (of[:, :, None] == of[:, None, :]).sum(axis=2)
                    largest = np.take_along_axis(of, count.argmax(axis=1)[:, None], axis=1)
                    take(at, at, (of != largest) | first)
            for a, n in zip(cuts[:-1][~tiny & (size > 1)], size[~tiny & (size > 1)], strict=True):
                at = a + np.argsort(node[a:a + n])
                if role[a] in (ASKS, ASKED):
                    asking, at = at[role[at] == ASKS], at[role[at] == ASKED]
                    if not len(asking) or not len(at):
                        continue
                else:
                    names, count = np.unique(root[at], return_counts=True)
                    asking = at[(root[at] != names[count.argmax()]) | first]
                stay[at] = True
                step = max(1, (1 << 20) // n)
                for b in range(0, len(asking), step):
                    take(asking[b:b + step], at, np.ones(len(asking[b:b + step]), bool))
                if not stay[asking].any():
                    stay[at] = False
            stay &= role != DEALT
            pairs = np.concatenate([np.zeros((0, 5), np.int64), *pairs])
            pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
            pairs = pairs[np.append(True, (pairs[1:, :2] != pairs[:-1, :2]).any(axis=1))[:len(pairs)]]
            none, no_place = pa.nulls(int(stay.sum()), pa.int64()), pa.nulls(len(pairs), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays([pa.array(pairs[:, i]), none]) for i in range(5)]
                + [pa.concat_arrays([no_place, pa.array(c[stay], pa.int64())])
                   for c in (h, part, node, role, score, last)], [*_PAIR, *_WORK])

        yield from map(found, _whole_groups(batches))

    return (rows.repartition("h", "part").sortWithinPartitions("h", "part").select(*_WORK, "root", "sig")
            .mapInArrow(search, ", ".join(f"{c} bigint" for c in [*_PAIR, *_WORK])))


def _links_within(rows: DataFrame, cut: float, same: Callable[[], Callable[[str, str], bool]]) -> DataFrame:
    """Links (a, c, ra, rc) from rows ``(h, part, node, role, score, last, root, sig,
    hs, text)``: those that join components among all pairs of a part that
    :func:`_next_partners` would give one after the other. ``hs`` are all bands h
    in which the node has rows; a pair is tested in the first that both have."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test, up = same(), {}

        def find(x: int) -> int:
            while (y := up.get(x, x)) != x:
                up[x] = up.get(y, y)
                x = y
            return x

        def links(group: pa.Table) -> Iterator[tuple[int, int, int, int]]:
            group = group.take(pa.array(np.argsort(group.column(2).to_numpy(), kind="stable")))
            h = group.column(0)[0].as_py()
            node, role, score, last, root = (group.column(i).to_numpy() for i in range(2, 7))
            if (root == root[0]).all():
                return
            (sig, registers), text = _words(group.column(7).combine_chunks()), group.column(9)
            bands = [frozenset(x) for x in group.column(8).to_pylist()]
            least = int(np.ceil(cut * registers - 1e-9))
            if role[0] in (ASKS, ASKED):
                asking, others = np.flatnonzero(role == ASKS), np.flatnonzero(role == ASKED)
            else:
                names, count = np.unique(root, return_counts=True)
                asking, others = np.flatnonzero(root != names[count.argmax()]), np.arange(len(node))
            tested: set[tuple[int, int]] = set()
            step = max(1, (1 << 20) // max(1, len(others)))
            for at in range(0, len(asking), step):
                ask = asking[at:at + step]
                agree = _agreeing(sig[ask], sig[others], registers)
                fit = (root[ask][:, None] != root[others]) & (agree >= least) & (
                    (agree < score[ask][:, None]) | (agree == score[ask][:, None])
                    & (node[others] > last[ask][:, None]))
                for i, agrees, fits in zip(ask, agree, fit, strict=True):
                    to = np.flatnonzero(fits)
                    for j in others[to[np.argsort(-agrees[to], kind="stable")]]:
                        a, c = sorted((int(node[i]), int(node[j])))
                        if find(int(root[i])) == find(int(root[j])) or (a, c) in tested or min(bands[i] & bands[j]) != h:
                            continue
                        tested.add((a, c))
                        if test(text[int(j)].as_py(), text[int(i)].as_py()):
                            ra, rc = (int(root[i]), int(root[j])) if node[i] == a else (int(root[j]), int(root[i]))
                            up[find(rc)] = find(ra)
                            yield a, c, ra, rc

        for table in _whole_groups(batches):
            h, part = table.column(0).to_numpy(), table.column(1).to_numpy()
            cuts = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (part[1:] != part[:-1]), [True])))
            found = [x for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b - a > 1
                     for x in links(table.slice(a, b - a))]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)]
                                             or [pa.array([], pa.int64())] * 4, _PAIR[:4])

    return (rows.repartition("h", "part").sortWithinPartitions("h", "part")
            .select(*_WORK, "root", "sig", "hs", "text")
            .mapInArrow(search, ", ".join(f"{c} bigint" for c in _PAIR[:4])).distinct())


def _placed(rows: DataFrame, role: int) -> DataFrame:
    """Rows (h, part, node) before their first partner."""
    return rows.select("h", F.col("part").cast("long"), "node", F.lit(role).cast("long").alias("role"),
                       F.lit(1 << 14).cast("long").alias("score"), F.lit(0).cast("long").alias("last"))


def _meetings(members: DataFrame, state: DataFrame) -> DataFrame:
    """Places of the rows (h, node, parts) of ``members`` in bands of several
    components: the nodes outside the band's largest component ask, in blocks,
    and each block meets each part. Nodes that do not ask are in one component."""
    rooted = staged(members.join(state.select("node", "root"), "node"), "rooted")
    largest = rooted.groupBy("h", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("h").agg(
        F.max_by("root", F.struct("n", "root")).alias("largest"), (F.sum("n") - F.max("n")).alias("asking"))
    ceil = F.ceil(F.col("asking") / PART_NODES)
    both = rooted.join(largest.filter("asking > 0").select("h", "largest", ceil.alias("blocks")), "h")
    block, part = (F.pmod(F.xxhash64("node", F.lit(c)), c) for c in ("blocks", "parts"))
    asks = both.filter("root <> largest").withColumn("block", block).withColumn(
        "of", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    asked = both.withColumn("of", part).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    place = F.col("block") * F.col("parts") + F.col("of")
    return _placed(asks.withColumn("part", place), ASKS).unionAll(_placed(asked.withColumn("part", place), ASKED))


def near_components(signed: DataFrame, texts: DataFrame, same: Callable[[], Callable[[str, str], bool]],
                    *, bands: int, rows: int, cut: float, slices: int = SLICES, sketch: int = SKETCH) -> DataFrame:
    """Rows ``(node, root, links)``, for every node with a near-duplicate: its
    component's smallest node and its number of verified links that joined
    components.

    ``signed`` (staged, deleted when it has been read) has rows as :func:`band_members` takes them, ``texts`` rows (key, text) of which
    equal keys have equal texts, ``same`` makes the exact test of two texts, and
    ``cut`` is the agreement of signatures below which a pair is not tested.
    """
    spark = signed.sparkSession
    banded = band_sets(signed, bands, rows, cut, slices=slices, sketch=sketch)
    # bands of the same nodes have the same pairs: one of them is searched
    members = staged(functools.reduce(DataFrame.unionAll, banded).groupBy("of").agg(
        F.min("h").alias("h"), F.min_by("nodes", "h").alias("nodes"))
        .select("h", F.explode("nodes").alias("node")), "members")
    dropped(*banded)
    large = staged(members.groupBy("h").agg(F.ceil(F.count(F.lit(1)) / PART_NODES).alias("parts"))
                   .filter("parts > 1"), "large-bands")
    # the nodes' keys are the small side of every task: no sort of all texts
    nodes = staged(members.select(F.col("node").alias("key")).distinct(), "nodes")
    thin = signed.select("key", "sig") if slice_columns(bands, slices)[0] in signed.columns else _thinned(signed)
    thin = thin.join(nodes.hint("shuffle_hash"), "key", "left_semi").dropDuplicates(["key"])
    state = staged(thin.select(F.col("key").alias("node"), F.col("key").alias("root"), "sig"), "components")
    dropped(signed, nodes)
    shuffles_freed(spark)

    # all of a small band's nodes, until they have left
    work = _placed(members.join(large, "h", "left_anti").withColumn("part", F.lit(0)), WHOLE)
    tried = edges = searched = meetings = left = own = None
    turn, deal = 0, not large.isEmpty()

    def joined(found: DataFrame) -> None:
        """The components that these links join are one: only roots are worked on."""
        nonlocal edges, state
        edges = found if edges is None else edges.unionAll(found)
        roots = components(found.select(F.col("ra").alias("a"), F.col("rc").alias("b")))
        old, state = state, staged(state.join(roots.select(F.col("node").alias("root"), F.col("root").alias("up")), "root", "left")
                                   .select("node", F.coalesce("up", "root").alias("root"), "sig"), "components")
        dropped(old)

    while turn < 2 or deal:
        rows = work if turn < 2 else None
        if deal:
            dealt = _placed(members.join(large, "h").withColumn("part", F.pmod(F.xxhash64("node", F.lit(turn)), "parts")), DEALT)
            rows = dealt if rows is None else rows.unionAll(dealt)
        old, searched = searched, staged(
            _next_partners(rows.join(state, "node"), cut, PARTNERS if turn else 1, turn == 0), "searched")
        shuffles_freed(spark)
        if turn < 2:
            dropped(old)        # what it left to do is in the new one
            left = searched
            work = left.filter("h is not null").select(*_WORK)
        pairs = searched.filter("h is null").select(*_PAIR)
        if turn == 0:       # texts of the nodes with a partner, or in a larger band
            met = work.unionByName(dealt.select(*_WORK)) if deal else work
            met = met.select(F.col("node").alias("key")).distinct().hint("shuffle_hash")
            own = staged(texts.join(met, "key", "left_semi").dropDuplicates(["key"]), "candidate-texts")
            shuffles_freed(spark)
            # the best of a node's bands, to begin with
            pairs = pairs.groupBy("a").agg(F.max_by(F.struct("c", "ra", "rc"), F.struct("agree", -F.col("c")))
                                           .alias("p")).select("a", "p.*")
        swap = F.col("a") < F.col("c")
        pairs = pairs.select(*[F.when(swap, F.col(y)).otherwise(F.col(x)).alias(x) for x, y in
                               (("a", "c"), ("c", "a"), ("ra", "rc"), ("rc", "ra"))]).distinct()
        new = staged(pairs if tried is None else pairs.join(tried.select("a", "c"), ["a", "c"], "left_anti"), "tried")
        found = staged(_verified(new, own, same), "verified")
        tried = new if tried is None else tried.unionAll(new)
        joined(found)
        # most nodes of a larger band join by deals; the rest, whatever its size, by meeting all
        deal = deal and found.count() * 2 > new.count()
        turn += 1
        if turn > 2:
            dropped(searched)
            searched = None
    if not large.isEmpty():
        meetings = staged(_meetings(members.join(large, "h"), state), "meetings")
        work = work.unionAll(meetings)
    # bands whose nodes have all joined need no texts
    apart = work.join(state.select("node", "root"), "node").groupBy("h", "part").agg(
        F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("h", "part")
    waiting = staged(work.join(apart.hint("shuffle_hash"), ["h", "part"], "left_semi").select(*_WORK), "waiting")
    dropped(left, meetings, members)
    hs = waiting.groupBy("node").agg(F.collect_set("h").alias("hs"))
    asked = staged(hs.join(state, "node").join(own.withColumnRenamed("key", "node"), "node"), "waiting-nodes")
    dropped(own)
    # a text goes with each place of its node: so many of them lie on disk at once
    links = [staged(_links_within(waiting.filter(F.pmod(F.xxhash64("h"), F.lit(REST)) == i).join(asked, "node"),
                                  cut, same), "verified") for i in range(REST)]
    dropped(waiting, asked)
    joined(functools.reduce(DataFrame.unionAll, links))
    shuffles_freed(spark)
    degree = edges.select("a").unionAll(edges.select(F.col("c").alias("a"))).groupBy("a").agg(
        F.count(F.lit(1)).alias("links"))
    return state.join(degree.withColumnRenamed("a", "node"), "node").select("node", "root", "links")
