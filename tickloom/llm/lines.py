"""Removal of lines that match an earlier line: an exact set-similarity join."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import batches, chunks, discard, hashed_words, mixed, stored
from tickloom.llm.setjoin import Repeated, TokenCounts, marked, overlaps, repeated, token_counts

PERCENT = 80
# Rows without an id come after the largest one: their line numbers start where no text's end.
NO_ID = (1 << 63) - 1
NO_ID_LINES = 1 << 31
# A line: order of its document, its number, and what tells apart texts under one id.
RID = "rid struct<doc:bigint,line:bigint,key:bigint>"
# Ids of documents, and numbers of their lines, that a task gets whole at most; more are shuffled.
BROADCAST_IDS = 200_000
BROADCAST_LINES = 1_000_000
SLICES = 2
# 64-bit words of a set's sketch.
SKETCH = ("s0", "s1", "s2", "s3")
# Tokens of a run at most, and how many bits rarer than one of all tokens a shorter one has to be.
RUN = 4
MARGIN = 8
# Signatures that a task sends on at once, and about how many are compared at once.
BLOCK = 1 << 20


def line_words(texts: list[str | None], wanted: list[list[int]] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lines with a word of all texts: text and line number of each, and the distinct
    word hashes of all of them (A-Z count as a-z) with the line they belong to, sorted by
    line and hash. ``wanted``: only these line numbers of each text."""
    bodies = [(text or "").encode() for text in texts]
    heights = np.array([body.count(b"\n") + 1 for body in bodies], np.int64)
    top = np.cumsum(heights) - heights
    data = b"\n".join(bodies)
    starts, hashes = hashed_words(data)
    line = np.cumsum(np.frombuffer(data, np.uint8) == ord("\n"), dtype=np.int64)[starts]
    if wanted is not None:
        chosen = np.zeros(heights.sum(), bool)
        for numbers, height, first in zip(wanted, heights, top):
            chosen[[first + number for number in numbers if number < height]] = True
        hashes, line = hashes[chosen[line]], line[chosen[line]]
    lines, of = np.unique(line, return_inverse=True)
    at = np.repeat(np.arange(len(texts)), heights)[lines]
    bits = np.uint64(max(1, len(lines).bit_length()))
    # Words are in the order of their lines already, so ``of`` stays as it is.
    hashes = hashes[np.argsort((of.astype(np.uint64) << (np.uint64(64) - bits)) | (hashes >> bits))]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    return at, lines - top[at], hashes[fresh], of[fresh]


def lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(values.view(np.int64)))


def packed(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Lists of values as bytes, which Spark moves whole."""
    ends = (values.itemsize * np.append(0, np.cumsum(sizes))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])


def unpacked(bodies: pa.Array, kind: type) -> pa.ListArray:
    size = np.dtype(kind).itemsize
    values = np.frombuffer(b"".join(bodies.to_pylist()), kind)
    sizes = pc.binary_length(bodies).to_numpy(zero_copy_only=False) // size
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(values))


def rids(doc: pa.Array, line: np.ndarray, key: pa.Array, at: np.ndarray) -> pa.StructArray:
    rows = pa.array(at, pa.int64())
    return pa.StructArray.from_arrays([doc.take(rows), pa.array(line, pa.int64()), key.take(rows)], ["doc", "line", "key"])


def earlier(one: str, two: str) -> str:
    """Lines with equal numbers of texts under one id: none is earlier than the other."""
    return f"({one}.doc < {two}.doc OR {one}.doc = {two}.doc AND {one}.line < {two}.line)"


def keyed(documents: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, bool]:
    """Append ``_doc, _first, _key``: rows agree in all of them if they have the same id and text.

    The key is a digest of the text where an id may stand for several texts, else 0. Also
    returned: whether an id, or none, stands in several rows.
    """
    none = F.col(doc_id).isNull()
    digest = F.xxhash64(F.col(text), none)
    ids = documents.select(F.col(doc_id).alias("i"), digest.alias("k"))
    ids = ids.groupBy("i").agg(F.min("k").alias("a"), F.max("k").alias("b"), F.count("*").alias("n"))
    several, again = ids.agg(F.max(F.expr("i IS NOT NULL AND a < b")), F.max(F.col("n") > 1)).first()
    own = documents.withColumns({
        "_doc": F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NO_ID)),
        "_first": F.when(none, F.lit(NO_ID_LINES)).otherwise(F.lit(0)).cast("bigint"),
        "_key": digest if several else F.when(none, digest).otherwise(F.lit(0)).cast("bigint"),
    })
    return own, bool(again)


def run_length(percent: int) -> int:
    """Consecutive tokens that matching sets share in their prefixes, see ``prefix_sizes``.

    Below 70 percent small sets need not share two; a single one is shared at every threshold.
    """
    return 2 if percent >= 70 else 1


def prefix_sizes(sizes: np.ndarray, percent: int) -> np.ndarray:
    """How many of a set's tokens, rarest first, hold a run that matching sets share.

    Let a set of n tokens match one that lacks a of them and has b others: a is at most
    (1 - t) * n - t * b. A token that the other set lacks is in k runs of k consecutive
    tokens, one that only the other has comes between the tokens of k - 1. For t of
    (k - 1) / k or more that spoils at most k * a + (k - 1) * b <= k * (1 - t) * n runs; the
    prefix has one more. The first run that is left is the same for both sets. A set that is
    too small to match a larger one has no prefix: only equal sets match.
    """
    run = run_length(percent)
    return np.where(100 * sizes >= percent * (sizes + 1), run * sizes * (100 - percent) // 100 + run, 0)


def longest_run(percent: int) -> int:
    """Runs of up to k tokens are told apart from a set's edits if (k - 1) / k <= t and 1 / k > 1 - t."""
    return max(1, min(RUN, 99 // max(1, 100 - percent)))


@dataclass
class Rarity:
    """Quarter bits by which a token is rarer than all tokens together, for every counter cell."""

    cells: np.ndarray
    once: int
    needed: int
    total: int

    def of(self, tokens: np.ndarray) -> np.ndarray:
        return TokenCounts.of(self, tokens)


def rarity(counts: TokenCounts) -> Rarity:
    total = max(2, int(counts.cells.sum(dtype=np.int64)))
    bits = np.round(4 * np.log2(total / np.maximum(counts.cells, 1).astype(np.float64))).clip(0, 255).astype(np.uint8)
    once = int(np.round(4 * np.log2(total)).clip(0, 255))
    return Rarity(bits, once, once + 4 * MARGIN, total)


def rare_runs(rare: np.ndarray, sizes: np.ndarray, percent: int, once: int, needed: int) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of the sets are kept, and the length of the run that starts at each, or 0.

    ``rare``: quarter bits of all tokens of one set after the other, rarest first. A run is as
    long as its tokens need to add up to ``needed``, at most ``longest_run``; beyond a set's end
    stand tokens that every set has. So lengths never fall within a set, and a token that the
    other set lacks spoils runs whose 1 / length add up to 1 at most: j of them reach it from
    j - 1 tokens before or nearer, each at least j long. One that only the other has spoils
    (j - 1) / j at most, which is no more than t. Let a and b be their numbers: a + t * b is at
    most (1 - t) * n, so runs whose 1 / length add up to more hold one that matching sets share,
    and the first shared one is the same for both. A token seen once is in no other set: it
    spends one of a, and no run holds it.
    """
    place = np.arange(len(rare))
    begin = np.cumsum(sizes) - sizes
    end = np.repeat(begin + sizes, sizes)
    upto = np.append(0, np.cumsum(rare, dtype=np.int64))
    lengths = np.ones(len(rare), np.int8)
    for k in range(1, longest_run(percent)):
        lengths += upto[np.minimum(place + k, end)] - upto[place] < needed
    alone = rare >= once
    # 12 times 1 / length, of the runs before this one.
    parts = np.where(alone, 0, 12 // lengths)
    spoilt = np.append(0, np.cumsum(parts))[:-1]
    lost = np.append(0, np.cumsum(alone))
    limit = 12 * ((100 - percent) * sizes - 100 * (lost[begin + sizes] - lost[begin]))
    limit[prefix_sizes(sizes, percent) == 0] = -1
    starts = ~alone & (100 * (spoilt - np.repeat(spoilt[begin], sizes)) <= np.repeat(limit, sizes))
    stop = np.zeros(len(sizes), np.int64)
    np.maximum.at(stop, np.repeat(np.arange(len(sizes)), sizes)[starts], (place + lengths)[starts])
    return ~alone & (place < np.repeat(stop, sizes)), np.where(starts, lengths, 0).astype(np.int8)


def runs(tokens: pa.ListArray, percent: int, lengths: pa.ListArray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of runs of consecutive tokens of each set, and its number.

    ``lengths``: of the run that starts at each token, 0 for none; one that reaches beyond the
    set's end is told from others by how far. Without them all runs of ``run_length`` within
    the sets.
    """
    values = tokens.flatten().to_numpy().view(np.uint32).astype(np.uint64)
    counts = np.diff(tokens.offsets.to_numpy())
    at = np.repeat(np.arange(len(counts)), counts)
    end = np.repeat(np.cumsum(counts), counts)
    if lengths is None:
        size = np.where(np.arange(len(values)) + run_length(percent) <= end, run_length(percent), 0)
    else:
        size = lengths.flatten().to_numpy()
    starts = np.flatnonzero(size)
    size, end = size[starts], end[starts]
    sigs = np.zeros(len(starts), np.uint64)
    for k in range(int(size.max(initial=0))):
        inside = starts + k < end
        token = np.where(inside, values[np.minimum(starts + k, len(values) - 1)], np.uint64(1 << 32))
        sigs = np.where(size > k, mixed((sigs << np.uint64(1)) ^ (sigs >> np.uint64(63)) ^ token), sigs)
    return sigs.view(np.int64), at[starts]


def repeated_runs(rows: DataFrame, blocks: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], total: int) -> Repeated:
    """Filter of the signatures that ``blocks`` makes of ``rows`` more than once, about ``total`` or fewer.

    They are dealt out by their first bits in blocks of bytes, so many that those with the same
    bits are about ``BLOCK``; a task sends a signature on at most twice at a time.
    """
    bits = (total // BLOCK).bit_length()

    def dealt(values: np.ndarray) -> pa.RecordBatch:
        found, times = np.unique(values.view(np.uint64), return_counts=True)
        found = np.sort(np.concatenate([found, found[times > 1]]))
        part = (found >> np.uint64(32) >> np.uint64(32 - bits)).astype(np.int64)
        sizes = np.bincount(part, minlength=1 << bits)
        parts = np.flatnonzero(sizes)
        return pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), packed(found, sizes[parts])], ["part", "body"])

    def deal(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for block in blocks(source):
            held.append(block)
            count += len(block)
            if count >= BLOCK:
                yield dealt(np.concatenate(held))
                held, count = [], 0
        if count:
            yield dealt(np.concatenate(held))

    def again(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bodies = [body for batch in frames for body in batch["body"].to_pylist()]
        values = np.sort(np.frombuffer(b"".join(bodies), np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(values[1:][values[1:] == values[:-1]]))], ["sig"])

    return marked(rows.mapInArrow(deal, "part bigint, body binary").groupBy("part").applyInArrow(again, "sig bigint"))


def matches(documents: DataFrame, percent: int = PERCENT, again_rows: bool = True) -> DataFrame:
    """``rid`` of the lines of ``doc, first, key, text`` that match an earlier one. See ``dedup``.

    ``again_rows``: rows may repeat a document and its key.
    """

    def blocks(source: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in chunks(source):
            yield hashed_words("\n".join(text or "" for text in batch["text"].to_pylist()).encode())[1]

    context = documents.sparkSession.sparkContext
    shared = context.broadcast(rarity(token_counts(documents.select("text"), blocks)))

    def sign(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in chunks(source):
            at, numbers, hashes, of = line_words(batch["text"].to_pylist())
            numbers = numbers + batch["first"].to_numpy(zero_copy_only=False)[at]
            sizes = np.bincount(of, minlength=len(at))
            begin = np.cumsum(sizes) - sizes
            scrambled = mixed(hashes)
            # A set's digest: two sums over its scrambled tokens, whatever their order. Its
            # sketch: 256 bits, each the parity of the tokens that fall on it.
            sums = [np.add.reduceat(mixed(scrambled ^ np.uint64(k)), begin) if len(begin) else scrambled for k in (1, 2)]
            bits, word = np.uint64(1) << (scrambled >> np.uint64(58)), scrambled & np.uint64(len(SKETCH) - 1)
            sketch = [np.bitwise_xor.reduceat(np.where(word == k, bits, 0), begin) if len(begin) else bits for k in range(len(SKETCH))]
            rare = known.of(hashes)
            # Rarest first; the sort is stable, so equally rare ones stay in the order of their hash.
            order = np.argsort((of.astype(np.uint64) << np.uint64(8)) | (255 - rare), kind="stable")
            used, length = rare_runs(rare[order], sizes, percent, known.once, known.needed)
            kept = np.bincount(of[used], minlength=len(at))
            # Half of a token's hash: tokens that agree in it only let more lines meet.
            prefix = (hashes[order][used] >> np.uint64(32)).astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [
                    rids(batch["doc"], numbers, batch["key"], at), pa.array(sizes, pa.int32()),
                    *[pa.array(x.view(np.int64)) for x in (*sums, *sketch)],
                    packed(prefix, kept), packed(length[used], kept),
                ],
                ["rid", "n", "d1", "d2", *SKETCH, "prefix", "lengths"],
            )

    sketches = ", ".join(f"{k} bigint" for k in SKETCH)
    kind = f"{RID}, n int, d1 bigint, d2 bigint, {sketches}, prefix binary, lengths binary"
    rows = stored(documents.mapInArrow(sign, kind))
    # One row per set: its first line is indexed. Most sets stand in one line and are not moved.
    twice = context.broadcast(repeated(rows.select(F.col("d1").alias("sig"))))

    def maybe_equal(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            yield batch.filter(pa.array(twice.value.among(batch["d1"].to_numpy())))

    def others_too(columns: list[str]) -> DataFrame:
        part = rows.select("d1", "d2", "rid", *columns)
        return part.mapInArrow(maybe_equal, part.schema)

    content = ["n", *SKETCH, "prefix", "lengths"]
    firsts = others_too(content).groupBy("d1", "d2")
    firsts = stored(firsts.agg(F.min("rid").alias("rid"), F.count("*").alias("copies"), F.min_by(F.struct(*content), "rid").alias("s")))
    multiple = firsts.filter("copies > 1").select("d1", "d2", F.col("rid").alias("first"))
    again = stored(others_too([]).join(multiple, ["d1", "d2"]).filter("rid <> first").select("rid", "first"))
    copies = again.filter(earlier("first", "rid")).select("rid")
    # As early as the first one, under the same id: these go if the first one does.
    twins = again.filter(f"NOT {earlier('first', 'rid')}")

    def reps(columns: list[str]) -> DataFrame:
        whole = rows.select("d1", F.lit(False).alias("taken"), *columns)
        return whole.union(firsts.select("d1", F.lit(True), *[c if c == "rid" else f"s.{c}" for c in columns]))

    def of_sets(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            first = batch["taken"].to_numpy(zero_copy_only=False) | ~twice.value.among(batch["d1"].to_numpy())
            yield batch.filter(pa.array(first))

    def runs_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        return runs(unpacked(batch["prefix"], np.int32), percent, unpacked(batch["lengths"], np.int8))

    def all_runs(source: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in of_sets(source):
            yield runs_of(batch)[0]

    # Most runs stand in one set and meet nobody: they are not moved.
    several = context.broadcast(repeated_runs(reps(["prefix", "lengths"]), all_runs, shared.value.total))

    def shared_runs(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = several.value
        for batch in of_sets(source):
            sigs, at = runs_of(batch)
            kept = known.among(sigs)
            rows_of = pa.array(at[kept], pa.int64())
            columns = ["rid", "n", *SKETCH]
            yield pa.RecordBatch.from_arrays([pa.array(sigs[kept]), *[batch[c].take(rows_of) for c in columns]], ["sig", *columns])

    index = stored(reps(["rid", *content]).mapInArrow(shared_runs, f"sig bigint, {RID}, n int, {sketches}"))
    discard(rows)
    discard(firsts)
    # Length filter, and no more different bits of the sketches than tokens that may differ.
    fits = (
        f"100 * least(n, n_a) >= {percent} * greatest(n, n_a) AND "
        f"{100 + percent} * ({' + '.join(f'bit_count({k} ^ {k}_a)' for k in SKETCH)}) <= {100 - percent} * (n + n_a)"
    )

    def shared_by(part: DataFrame) -> DataFrame:
        """The rows under a run of several lines; ``pair``: with a line of the first document, where it fits."""
        of = {"lead_line": "rid.line", "lead_key": "rid.key", "n_a": "n", **{f"{k}_a": k for k in SKETCH}}
        leaders = part.groupBy("sig").agg(
            F.min("rid.doc").alias("lead_doc"), F.count("*").alias("c"), *[F.min_by(v, "rid.doc").alias(k) for k, v in of.items()]
        ).filter("c > 1")
        leaders = leaders.withColumn("lead", F.struct(F.col("lead_doc").alias("doc"), F.col("lead_line").alias("line"), F.col("lead_key").alias("key")))
        met = part.join(leaders, "sig")
        pair = f"CASE WHEN NOT ({fits}) THEN NULL WHEN {earlier('lead', 'rid')} THEN struct(lead AS a, rid AS b) WHEN {earlier('rid', 'lead')} THEN struct(rid AS a, lead AS b) END"
        met = met.select("sig", "rid", "n", *SKETCH, "c", F.expr(pair).alias("pair"))
        # A group of two has no more pairs than that with its leader.
        return met.filter("c > 2 OR pair IS NOT NULL")

    # Runs are dealt with in slices, one after the other: shuffle files of one slice at a time.
    slices = [stored(shared_by(index.filter(F.expr(f"pmod(sig, {SLICES}) = {k}")))) for k in range(SLICES)]
    discard(index)

    def sets(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(source):
            at, numbers, hashes, of = line_words(batch["text"].to_pylist(), batch["numbers"].to_pylist())
            lines_of = rids(batch["doc"], numbers + batch["first"].to_numpy(zero_copy_only=False)[at], batch["key"], at)
            yield pa.RecordBatch.from_arrays([lines_of, lists(hashes, np.bincount(of, minlength=len(at)))], ["rid", "tokens"])

    def tokens_of(ids: DataFrame) -> DataFrame:
        number = F.expr(f"cast(rid.line % {NO_ID_LINES} as int)")
        numbers = ids.groupBy(F.col("rid.doc").alias("doc"), F.col("rid.key").alias("key"))
        numbers = stored(numbers.agg(F.collect_set(number).alias("numbers")))
        size = numbers.agg(F.count("*").alias("ids"), F.coalesce(F.sum(F.size("numbers")), F.lit(0)).alias("lines")).first()
        few = size["ids"] <= BROADCAST_IDS and size["lines"] <= BROADCAST_LINES
        found = documents.join(F.broadcast(numbers) if few else numbers, ["doc", "key"]).mapInArrow(sets, f"{RID}, tokens array<bigint>")
        return stored(found.dropDuplicates(["rid"]) if again_rows else found)

    led = [part.filter("pair IS NOT NULL").select("pair.a", "pair.b") for part in slices]
    first_pairs = stored(reduce(DataFrame.union, led).distinct())
    found = tokens_of(first_pairs.select(F.col("a").alias("rid")).union(first_pairs.select("b")))
    gone = stored(overlaps(first_pairs, found, percent).select(F.col("b").alias("rid")).distinct())
    discard(found)
    few_gone = gone.count() <= BROADCAST_IDS

    # Lines not settled by the leaders look for any earlier line under their runs. Nothing is
    # listed by pairs: lines that a sketch lets meet another are kept, then those with a match.
    groups = [part.filter("c > 2").select("sig", "rid", "n", *SKETCH) for part in slices]

    def named(part: DataFrame, end: str) -> DataFrame:
        return part.select(*[F.col(x).alias("sig" if x == "sig" else x + end) for x in part.columns])

    def meeting(part: DataFrame, others: DataFrame, ahead: str, behind: str, condition: str = fits) -> DataFrame:
        """The rows of ``part`` that meet one of ``others`` under a run."""
        one, two = part.alias("p"), named(others, "_a").alias("o")
        return one.join(two, F.expr(f"p.sig = o.sig AND {earlier(ahead, behind)} AND {condition}"), "left_semi")

    def open_ones(part: DataFrame) -> DataFrame:
        rest = part.join(F.broadcast(gone) if few_gone else gone, "rid", "left_anti").select(*part.columns)
        return meeting(rest, part, "rid_a", "rid")

    late = reduce(DataFrame.union, [stored(open_ones(part)) for part in groups])
    early = stored(reduce(DataFrame.union, [meeting(part, late, "rid", "rid_a") for part in groups]))
    for part in slices:
        discard(part)
    found = tokens_of(late.select("rid").union(early.select("rid")))
    both = "size(array_intersect(tokens, tokens_a))"
    exact = f"{fits} AND 100 * {both} >= {percent} * (size(tokens) + size(tokens_a) - {both})"
    more = stored(meeting(late.join(found, "rid"), early.join(found, "rid"), "rid_a", "rid", exact).select("rid").distinct())
    met = stored(gone.union(more))
    return copies.union(met).union(twins.join(met.select(F.col("rid").alias("first")).distinct(), "first").select("rid"))


def dedup(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The documents with ``text`` less its repeated lines, ``n_lines`` and ``n_removed``.

    A line goes if an earlier one, by (doc_id, line number), has a word set with 100 *
    intersection >= percent * union, both as they stand in the input. Lines without a word
    stay. Null texts stay null; rows that repeat an id and a text lose the same lines. Other
    texts under one id are documents of their own, as are those without an id, which come
    last; between these only the line number decides which line is earlier.
    """
    rows, again = keyed(documents, doc_id, text)
    own = rows.select(F.col("_doc").alias("doc"), F.col("_first").alias("first"), F.col("_key").alias("key"), F.col(text).alias("text"))
    removed = matches(own, percent, again)
    numbers = removed.groupBy(F.col("rid.doc").alias("_doc"), F.col("rid.key").alias("_key")).agg(
        F.collect_set(F.expr(f"cast(rid.line % {NO_ID_LINES} as int)")).alias("_gone")
    )
    joined = rows.join(numbers, ["_doc", "_key"], "left").select(*documents.columns, "_gone")
    at = joined.columns.index(text)
    names = [*documents.columns, "n_lines", "n_removed"]

    def cut(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            texts, counts, losses = [], [], []
            for value, gone in zip(batch[at].to_pylist(), batch["_gone"].to_pylist()):
                lines = value.split("\n") if value is not None else []
                away = set(gone or ())
                kept = [line for i, line in enumerate(lines) if i not in away]
                texts.append(None if value is None else "\n".join(kept))
                counts.append(sum(bool(line.encode().split()) for line in lines))
                losses.append(len(lines) - len(kept))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(losses, pa.int64())], names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return joined.mapInArrow(cut, f"{fields}, n_lines bigint, n_removed bigint")
