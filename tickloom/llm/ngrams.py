"""Jaccard join of word 5-grams with token-combination prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import batches, discard, mixed, stored, windows_hash, word_hashes
from tickloom.llm.setjoin import TokenCounts, components, overlaps, repeated, token_counts

WORDS = 5
PERCENT = 75
# 64-bit words of a set's sketch.
WIDE = 8
# Rounds in which every set meets one more leader, at most; what they leave open, all pairs settle.
ROUNDS = 6


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """Distinct hashes of the runs of ``size`` words; the whole sequence if shorter."""
    hashes = word_hashes(words)
    if 0 < len(hashes) < size:
        return windows_hash(hashes, len(hashes)) ^ np.uint64(len(hashes))
    return np.unique(windows_hash(hashes, size))


def lowered(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []  # bytes.lower(): A-Z only


def signatures(found: np.ndarray, counts: TokenCounts, frequent: int, percent: int) -> tuple[np.ndarray, int]:
    """What a set is indexed under, in order of position, and its number of rare tokens.

    Tokens are ordered rarest first. Two sets that reach the threshold share a token of their
    prefixes of (1 - t) * size + 1. Rare tokens there are indexed singly. If the prefix
    reaches the frequent tokens, it is extended to 2 * (1 - t) * size + 2 tokens, and pairs of
    frequent tokens that follow each other are indexed: at most (1 - t) of the union is not
    shared, each such token separates one pair of shared ones, and the extended prefix has
    more shared tokens than that. Pairs matter for sets that share no rare token, so that
    the number of rare ones is the position of every pair.
    """
    ordered = counts.ordered(found)
    rare = int((counts.of(found) < frequent).sum())
    spare = len(found) * (100 - percent) // 100
    singles = ordered[: min(spare + 1, rare)]
    if rare > spare:
        return singles, rare
    frequents = ordered[rare : 2 * spare + 3]
    if len(frequents) > 1:
        pairs = windows_hash(frequents, 2)
    else:  # a set of one token: its own combination
        pairs = mixed(frequents) if len(found) == 1 else frequents[:0]
    return np.append(singles, pairs), rare


def sketch(found: np.ndarray) -> np.ndarray:
    """Parities of the tokens that fall on each of 64 * WIDE bits: two sets differ in at
    least as many tokens as their sketches differ in bits."""
    scrambled = mixed(found ^ np.uint64(0x5851F42D4C957F2D))
    bits = np.zeros(WIDE, np.uint64)
    cell = ((scrambled >> np.uint64(6)) % np.uint64(WIDE)).astype(np.int64)
    np.bitwise_xor.at(bits, cell, np.uint64(1) << (scrambled & np.uint64(63)))
    return bits.view(np.int64)


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per document ``doc_id, n_shingles, component_id``.

    Documents link at 100 * intersection >= percent * union of their shingle sets; the
    component is the smallest id reachable. Null and empty texts link with nothing. Rows
    with equal ids are one node each with that id; a null id stays alone (component null),
    whatever its text.

    Equal word sequences collapse to their smallest id first. Signatures of one set only are
    left out. In a few rounds every set is verified against one smaller or, later, one
    differently grouped leader under its signatures, which joins groups of near copies
    without listing their pairs. Last, all pairs under a signature that are not yet in one
    component are verified, so that no link that matters is lost; sketches of the sets
    keep pairs out that differ in too many tokens.
    """
    own = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def blocks(source: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches(source):
            found = [shingles(lowered(t), size) for t in batch["text"].to_pylist()]
            if found:
                yield np.concatenate(found)

    shared = own.sparkSession.sparkContext.broadcast(token_counts(own.select("text"), blocks))

    bits = [f"s{k}" for k in range(WIDE)]
    names = ["row", "doc_id", "n", "d1", "d2", "rare", "sigs", *bits]

    def sign(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        frequent = counts.frequent
        for batch in batches(source):
            rows = []
            for row, name, value in zip(*(batch[c].to_pylist() for c in ("row", "doc_id", "text"))):
                words = lowered(value)
                found = shingles(words, size)
                digest = np.frombuffer(xxhash.xxh3_128_digest(b" ".join(words)), np.int64).tolist()
                sigs, rare = signatures(found, counts, frequent, percent)
                rows.append((row, name, len(found), *digest, rare, sigs.view(np.int64), *sketch(found).tolist()))
            columns = list(zip(*rows)) or [()] * len(names)
            kinds = [pa.int64()] * 6 + [pa.list_(pa.int64())] + [pa.int64()] * WIDE
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    kind = ", ".join(f"{name} array<bigint>" if name == "sigs" else f"{name} bigint" for name in names)
    signed = stored(own.withColumn("row", F.monotonically_increasing_id()).mapInArrow(sign, kind))
    rows = stored(signed.select("doc_id", "n", "d1", "d2"))
    place = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "row"))
    firsts = signed.filter("n > 0").groupBy("d1", "d2").agg(F.min(place).alias("p"))
    firsts = stored(firsts.select("d1", "d2", F.col("p.doc_id").alias("first"), F.col("p.row").alias("row")))
    one_each = signed.join(firsts.select("d1", "d2", "row"), ["d1", "d2", "row"])
    reps = stored(one_each.select(F.col("doc_id").alias("rid"), "n", "rare", "sigs", *bits))
    discard(signed)
    several = own.sparkSession.sparkContext.broadcast(repeated(reps.select(F.explode("sigs").alias("sig"))))

    def shared_only(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = several.value
        for batch in batches(source):
            sigs = batch["sigs"].combine_chunks() if isinstance(batch["sigs"], pa.ChunkedArray) else batch["sigs"]
            values = sigs.flatten().to_numpy()
            sizes = np.diff(sigs.offsets.to_numpy())
            at = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            kept = known.among(values)
            at, place = at[kept], place[kept]
            place = np.minimum(place, batch["rare"].to_numpy()[at])
            rid, n = batch["rid"].to_numpy()[at], batch["n"].to_numpy()[at]
            yield pa.RecordBatch.from_arrays([pa.array(values[kept]), pa.array(place), pa.array(rid), pa.array(n)], ["sig", "pos", "rid", "n"])

    index = stored(reps.select("rid", "n", "rare", "sigs").mapInArrow(shared_only, "sig bigint, pos bigint, rid bigint, n bigint"))
    sketches = stored(reps.select("rid", "n", *bits))
    discard(reps)
    # Length filter, and the overlap still possible after the first shared token.
    fits = (
        f"100 * least(n, n_a) >= {percent} * greatest(n, n_a) AND "
        f"{100 + percent} * least(n - pos, n_a - pos_a) >= {percent} * (n + n_a)"
    )
    apart = " + ".join(f"bit_count({b} ^ {b}_a)" for b in bits)
    alike = f"{100 + percent} * ({apart}) <= {100 - percent} * (n + n_a)"

    def sets(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            found = [shingles(lowered(t), size).view(np.int64) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["rid"], pa.array(found, pa.list_(pa.int64()))], ["rid", "tokens"])

    def verified(pairs: DataFrame) -> DataFrame:
        """The stored pairs (a, b) that are links."""
        ids = pairs.select(F.col("a").alias("rid")).union(pairs.select("b")).distinct()
        texts = own.withColumnRenamed("doc_id", "rid").join(ids, "rid", "left_semi")
        tokens = stored(texts.mapInArrow(sets, "rid bigint, tokens array<bigint>"))
        found = stored(overlaps(pairs, tokens, percent).distinct())
        discard(tokens)
        return found

    other = [F.col("rid").alias("a"), F.col("n").alias("n_a"), *[F.col(b).alias(f"{b}_a") for b in bits]]

    def sketched(pairs: DataFrame) -> DataFrame:
        """Less the pairs whose sketches are too far apart."""
        return pairs.join(sketches.select(*other), "a").join(sketches.withColumnRenamed("rid", "b"), "b").filter(alike).select("a", "b")

    links = own.sparkSession.createDataFrame([], "a bigint, b bigint")
    tried = links
    left = index.withColumns({"component": F.col("rid"), "members": F.lit(1)})
    for round_ in range(ROUNDS + 1):
        sums = left.groupBy("sig").agg(
            F.count("*").alias("c"), F.min("component").alias("x"), F.max("component").alias("y"),
            F.min_by(F.struct("rid", "component", "n", "pos"), F.struct(-F.col("members"), F.col("component"), F.xxhash64("rid", F.lit(round_)) if round_ else F.col("rid"))).alias("lead"),
        ).filter("x < y").select("sig", "c", "lead")
        # Of a set of signatures, those under which several components meet stay.
        open_ = stored(left.join(sums, "sig"))
        if round_:
            discard(left)
        left = open_
        work = left.agg(F.sum("c").alias("pairs"), F.count("*").alias("rows")).first()
        if not work["rows"] or round_ == ROUNDS or round_ and work["pairs"] <= 8 * work["rows"]:
            break
        met = left.withColumns({"n_a": F.col("lead.n"), "pos_a": F.col("lead.pos")}).filter(f"component <> lead.component AND {fits}")
        counted = met.groupBy(F.col("lead.rid").alias("a"), F.col("rid").alias("b")).agg(F.count("*").alias("c"))
        if round_:
            counted = counted.join(tried, ["a", "b"], "left_anti")
        # Every set meets the leader that it shares most signatures with.
        best = counted.groupBy("b").agg(F.max(F.struct("c", (-F.col("a")).alias("m")))["m"].alias("m"))
        pairs = stored(best.select((-F.col("m")).alias("a"), "b"))
        found = verified(stored(sketched(pairs)))
        tried = tried.union(pairs)
        links = stored(links.union(found))
        known = components(links)
        sizes = known.groupBy("component").agg(F.count("*").alias("members"))
        known = known.join(sizes, "component").withColumnRenamed("node", "rid")
        rest = left.select("sig", "pos", "rid", "n").join(known, "rid", "left")
        left = stored(rest.select("sig", "pos", "rid", "n", F.coalesce("component", "rid").alias("component"), F.coalesce("members", F.lit(1)).alias("members")))
        discard(open_)
        if found.count() * 20 < pairs.count():
            # Few links are left to find: leaders would settle no more.
            ends = left.groupBy("sig").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("sig")
            left = stored(left.join(ends, "sig", "left_semi"))
            break
    rest = left.select("sig", "pos", "rid", "n", "component").join(sketches.drop("n"), "rid")
    one = rest.select("sig", F.col("pos").alias("pos_a"), F.col("component").alias("of_a"), *other)
    meet = F.expr(f"a < b AND component <> of_a AND {fits} AND {alike}")
    two = rest.withColumnRenamed("rid", "b").withColumnRenamed("sig", "sig_b")
    more = one.join(two, (F.col("sig") == F.col("sig_b")) & meet).select("a", "b").distinct()
    links = stored(links.union(verified(stored(more))))
    discard(left)
    discard(index)
    discard(sketches)
    final = components(links)
    member = firsts.join(final, F.col("first") == F.col("node"), "left").select("d1", "d2", F.coalesce("component", "first").alias("component_id"))
    linked = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    return rows.join(member, ["d1", "d2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(linked, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )
