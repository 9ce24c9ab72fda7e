"""Near duplicates by SuperMinHash signatures, bands, exact checks and union-find."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.components import components
from ledgerline.llm.superminhash import band_keys, identity, shingle_sets, signatures
from ledgerline.llm.tables import cut
from ledgerline.llm.words import batches

# Shingles in a block of a bucket's documents; each document counts DOCUMENT more, so a block has 512 at most.
BLOCK = 1 << 22
DOCUMENT = 1 << 13


def _texts(column: pa.Array) -> list[bytes]:
    return [v or b"" for v in column.to_pylist()]


def sign(docs: DataFrame, width: int, registers: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, h1, h2, sig, keys): set size, identity of the set, 16 bits of each register and 32 of each band key, band keys."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = _texts(part.column(1))
            for first, last in batches(texts):
                sets = shingle_sets(texts[first:last], width)
                signed = signatures(sets, registers)
                keys = band_keys(signed, bands, rows)
                short = [a.tobytes() + b.tobytes() for a, b in zip(signed.astype(np.uint16), keys.astype(np.uint32))]
                marks = [identity(s) for s in sets]
                yield pa.RecordBatch.from_arrays([
                    part.column(0).slice(first, last - first),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([m[0] for m in marks], pa.int64()), pa.array([m[1] for m in marks], pa.int64()),
                    pa.array(short, pa.binary()),
                    pa.array([k if len(s) else None for k, s in zip(keys.tolist(), sets)], pa.list_(pa.int64())),
                ], ["doc_id", "n_shingles", "h1", "h2", "sig", "keys"])

    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(
        run, "doc_id long, n_shingles long, h1 long, h2 long, sig binary, keys array<long>")


def shingles_of(docs: DataFrame, width: int) -> DataFrame:
    """(id, h1, h2, shingles): the sorted hashes of each text's set as bytes."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = _texts(part.column(1))
            for first, last in batches(texts):
                sets = shingle_sets(texts[first:last], width)
                marks = [identity(s) for s in sets]
                yield pa.RecordBatch.from_arrays([
                    part.column(0).slice(first, last - first),
                    pa.array([m[0] for m in marks], pa.int64()), pa.array([m[1] for m in marks], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ], ["id", "h1", "h2", "shingles"])

    return docs.select(F.col("doc_id").alias("id"), F.col("text").cast("binary")).mapInArrow(
        run, "id long, h1 long, h2 long, shingles binary")


def near(p: np.ndarray, q: np.ndarray, part: int, whole: int) -> bool:
    """Whether whole * |p and q| >= part * |p or q|, for sorted distinct hashes."""
    if len(p) > len(q):
        p, q = q, p
    shared = int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum())
    return whole * shared >= part * (len(p) + len(q) - shared)


def linked(pairs: DataFrame, sets: DataFrame, part: int, whole: int) -> DataFrame:
    """The pairs (a, b) with whole * intersection >= part * union on the full sets."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                keep.append(near(*(np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y)), part, whole))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], ["a", "b"])

    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    sizes = F.expr(f"{whole} * least(octet_length(x), octet_length(y)) >= {part} * greatest(octet_length(x), octet_length(y))")
    return (pairs.join(left, "a").join(right, "b").where(sizes).select("a", "b", "x", "y")
            .mapInArrow(run, "a long, b long").distinct())


def strangers(members: DataFrame, part: int, whole: int, registers: int) -> DataFrame:
    """(key, i, j, id, component, wants): blocks of a bucket's ids, with the ids that each may be linked to.

    members: (key, band, id, component, n_shingles, sig). In a band's bucket the ids outside its most common
    component ask all ids of other components, in blocks of a bounded number of shingles. A pair is left out
    only where sizes forbid the link, where the signatures agree on less than the threshold minus six
    standard deviations of the estimate, or where an earlier band holds both ids. Each id gives a
    row per block at most, whatever the number of its partners.
    """
    share = part / whole
    least = (share - 6 * (share * (1 - share) / registers) ** 0.5) * registers
    counts = members.groupBy("key", "component").agg(F.count("*").alias("n"), F.sum(F.col("n_shingles") + DOCUMENT).alias("size"))
    common = counts.groupBy("key").agg(
        F.max_by("component", F.struct("n", "component")).alias("common"), F.max_by("size", F.struct("n", "component")).alias("most"),
        F.sum("size").alias("all")).where("all > most")
    members = members.join(common, "key").withColumns(
        {"n": F.expr(f"1 + (all - most) DIV {BLOCK}"), "m": F.expr(f"1 + all DIV {BLOCK}")})
    columns = ["band", "id", "component", "common", "n_shingles", "sig"]
    outside = members.where("component <> common").select(
        "key", F.expr("pmod(xxhash64(id), n) AS i"), F.expr("explode(sequence(0L, m - 1)) AS j"), *columns, F.lit(True).alias("asks"))
    every = members.select(
        "key", F.expr("explode(sequence(0L, n - 1)) AS i"), F.expr("pmod(xxhash64(id), m) AS j"), *columns, F.lit(False).alias("asks"))

    def meet(block: pd.DataFrame) -> pd.DataFrame:
        left, right = block[block["asks"]], block[~block["asks"]]
        rows, wanted = [], np.zeros(len(right), dtype=bool)
        if len(left) and len(right):
            band = int(block["band"].iloc[0])
            sig = np.frombuffer(b"".join(right["sig"]), dtype=np.uint8).reshape(len(right), -1)
            short, keys = (sig[:, a:b].copy().view(t) for a, b, t in ((0, 2 * registers, np.uint16), (2 * registers, None, np.uint32)))
            ids, size, own = (right[c].to_numpy() for c in ("id", "n_shingles", "component"))
            apart = (right["component"] != right["common"]).to_numpy()
            for i, comp, n, mine in zip(left["id"], left["component"], left["n_shingles"], left["sig"]):
                fit = (own != comp) & ~(apart & (ids < i)) & (whole * np.minimum(size, n) >= part * np.maximum(size, n))
                at = np.flatnonzero(fit)
                if len(at):
                    agree = (short[at] == np.frombuffer(mine, dtype=np.uint16, count=registers)).sum(axis=1)
                    before = (keys[at, :band] == np.frombuffer(mine, dtype=np.uint32, offset=2 * registers, count=band)).any(axis=1)
                    at = at[(agree >= least) & ~before]
                if len(at):
                    wanted[at] = True
                    rows.append((i, comp, ids[at]))
            rows += [(i, comp, None) for i, comp in zip(ids[wanted], own[wanted])]
        out = pd.DataFrame(rows, columns=["id", "component", "wants"])
        for name in ("key", "i", "j"):
            out[name] = block[name].iloc[0]
        return out

    return outside.union(every).groupBy("key", "i", "j").applyInPandas(
        meet, "id long, component long, wants array<long>, key long, i long, j long")


def block_links(blocks: DataFrame, sets: DataFrame, part: int, whole: int) -> DataFrame:
    """Links (a, b) of the wanted pairs, confirmed on full sets, as many as join their block's components."""

    def check(block: pd.DataFrame) -> pd.DataFrame:
        full: dict[int, list[np.ndarray]] = {}
        for i, s, wants in zip(block["id"], block["shingles"], block["wants"]):
            if wants is None:
                full.setdefault(i, []).append(np.frombuffer(s, dtype=np.uint64))
        parent = {c: c for c in block["component"]}
        where = dict(zip(block["id"], block["component"]))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        found = []
        for i, s, wants in zip(block["id"], block["shingles"], block["wants"]):
            for j in wants if wants is not None else ():
                a, b = root(where[i]), root(where[j])
                if a != b and any(near(np.frombuffer(s, dtype=np.uint64), q, part, whole) for q in full[j]):
                    parent[a] = b
                    found.append((i, j))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return blocks.join(sets, "id").groupBy("key", "i", "j").applyInPandas(check, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, part: int = 85,
                    whole: int = 100, registers: int = 128, bands: int = 25, rows: int = 5) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least id that links reach), kept.

    Two documents are linked when whole * |A and B| >= part * |A or B| over their sets of word shingles.
    Equal sets meet as one class, so copies are never paired. Classes that share a band of their
    SuperMinHash signature are candidates; a pair at the threshold shares none of the 25 bands of 5 with probability
    4e-7. First every class of a bucket is checked against the bucket's least id; then all pairs whose
    ends still lie in different components are. Pairs inside one component could not change the
    result. Every link is confirmed on the full sets.

    Null or blank texts have an empty set and stay alone. Rows without an id get no component and are kept.
    Rows that repeat an id are one document: they share a component, and each has its own n_shingles.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = cut(sign(docs, width, registers, bands, rows))
    known = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = cut(known.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"), F.first("keys").alias("keys")))

    posted = classes.select("id", F.posexplode("keys").alias("band", "key"))
    buckets = posted.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("last")).where("a < last").select("key", "a")
    members = cut(posted.join(buckets, "key"))
    stars = members.where("id <> a").select("a", F.col("id").alias("b")).distinct()
    involved = members.select("id").distinct().join(classes, "id").select("id", "h1", "h2")
    sets = cut(docs.withColumnRenamed("doc_id", "id").join(involved.hint("shuffle_hash"), "id").select(
        F.col("id").alias("doc_id"), "text").transform(lambda d: shingles_of(d, width)).join(
        involved, ["id", "h1", "h2"], "left_semi").dropDuplicates(["id", "h1", "h2"]).select("id", "shingles"))
    links = cut(linked(stars, sets, part, whole))

    first = components(links)
    placed = (members.join(first, "id", "left").join(classes.select("id", "n_shingles", "sig"), "id")
              .select("key", "band", "id", F.coalesce("component", "id").alias("component"), "n_shingles", "sig"))
    more = block_links(cut(strangers(placed, part, whole, registers)), sets, part, whole)

    member_of = known.select("doc_id", "h1", "h2").join(classes.select("h1", "h2", "id"), ["h1", "h2"])
    repeated = (member_of.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z")
                .select("doc_id").join(member_of, "doc_id").selectExpr("doc_id a", "id b"))
    final = components(links.union(more).union(repeated))
    named = classes.join(final, "id", "left").select("h1", "h2", F.coalesce("component", "id").alias("component"))
    return (signed.join(named, ["h1", "h2"], "left").select(
        "doc_id", "n_shingles",
        F.expr("CASE WHEN doc_id IS NULL THEN NULL WHEN n_shingles = 0 THEN doc_id ELSE component END").alias("component_id"))
        .withColumn("kept", F.expr("component_id IS NULL OR doc_id = component_id")))
