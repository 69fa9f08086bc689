"""SimHash near-duplicates by deletion-variant signatures.

Fingerprint: the text with A-Z lower-cased, its words
(``[^\\x20\\x09-\\x0D]+``), all ``shingle``-word shingles with repeats, joined by
one space (a shorter text is one shingle; no word: fingerprint 0); a bit is 1
if it is set in over half of the shingles' XXH64 values (seed 42).

Links (distance at most ``MAX_BITS`` = 2): the 64 bits are cut into two
segments of 32, fewer than the three that equal segments would need, because
of two differing bits one segment has at most one. Each distinct fingerprint
is indexed under each segment with one bit deleted (a wildcard): 64 variants.
Fingerprints at distance 2 or less share a variant of some segment, so an
equality join on (segment, wildcard, remaining bits) and a check of the bit
count finds every link.

Variants shared by more than ``HOT`` fingerprints are not paired: each of
their fingerprints is indexed under all variants with two of its 64 bits
deleted (2016). Two fingerprints share such a variant exactly if they are
within two bits, so all that share one are linked to its smallest and no link
is lost; work stays linear in the size of a hot group.

Equal fingerprints are collapsed before all this. Components come from
alternating large-star and small-star steps over the links, stored each
round; nothing of them passes through the driver but the number of changes.

Defined cases: null and empty texts get fingerprint zero and are linked like
any other; repeated ids count once for the component (the smallest id names
it) and keep all their rows; null ids never name a component (a component of
null ids only has a null one); an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinsift.llm import common

SHINGLE = 3
MAX_BITS = 2
HOT = 48
TASK = 8192  # fingerprints of a task, times 64 keys
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of one text; bit counts go in chunks, so the
    memory does not grow with the text."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(tokens) - shingle + 1
    if not tokens:
        return 0
    if n < 1:
        return xxhash.xxh64_intdigest(b" ".join(tokens), 42)
    xx = xxhash.xxh64_intdigest
    if shingle == 3:
        grams = map(b"%b %b %b".__mod__, zip(tokens, tokens[1:], tokens[2:], strict=False))
    else:
        grams = map(b" ".join, zip(*[tokens[i:] for i in range(shingle)], strict=False))
    hashes = np.array([xx(g, 42) for g in grams], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        ones += np.unpackbits(hashes[at:at + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (ones * 2 > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long. No shuffle."""
    thin = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = thin.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return common.map_batches(thin, run, f"doc_id {id_type}, fp long")


def variants(fps: DataFrame) -> DataFrame:
    """(fp, v), 64 rows a fingerprint: v has segment and wildcard in its top
    bits and the segment's other 31 bits. One short expression over the number
    i of the wildcard: 64 long ones made the driver's plans and code large."""
    half, bit = "(shiftrightunsigned(fp, i & 32) & 4294967295)", "(i & 31)"
    v = f"shiftleft(shiftright({half}, {bit} + 1), {bit}) | ({half} & (shiftleft(1L, {bit}) - 1L)) | shiftleft(cast(i as bigint), 32)"
    return fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("i")).select("fp", F.expr(v).alias("v"))


def without_two(fps: DataFrame) -> DataFrame:
    """(fp, m, rest), 2016 rows a fingerprint: rest has the two bits that m
    names as 0."""
    one = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(62))).alias("i"))
    two = one.select("fp", "i", F.explode(F.expr("sequence(i + 1, 63)")).alias("j"))
    return two.select("fp", F.expr("i * 64 + j").alias("m"), F.expr("fp & ~(shiftleft(1L, i) | shiftleft(1L, j))").alias("rest"))


def links(fps: DataFrame, hot: int = HOT) -> DataFrame:
    """(src, dst) links between distinct fingerprints ``fp`` within two bits;
    for the groups of hot variants, links to a common neighbour."""
    # Counting its keys, nearly all different, a task holds them all.
    keys = variants(fps.repartition(max(1, -(-fps.count() // TASK)), "fp"))
    sizes = keys.groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("src"), F.max("fp").alias("dst"))
    sizes = common.stored(sizes.where("n > 1"), "simhash-buckets")
    # Two fingerprints are their least and their greatest.
    two_of = sizes.where("n = 2 and bit_count(src ^ dst) <= 2").select("src", "dst")
    # The members of larger groups; merged, as their number has no bound.
    members = keys.join(sizes.where("n > 2").select("v", "n").hint("merge"), "v")
    members = common.stored(members, "simhash-members")
    groups = members.where(F.col("n") <= hot).groupBy("v").agg(F.sort_array(F.collect_list("fp")).alias("f"))
    # At most HOT fingerprints a group; of its pairs only the links leave.
    pairs = groups.select(F.explode(F.expr(
        "flatten(transform(f, (a, i) -> transform(filter(f, (b, j) -> j < i and bit_count(a ^ b) <= 2), "
        "b -> struct(a as src, b as dst))))")).alias("p")).select("p.src", "p.dst")
    hot_f = common.stored(members.where(F.col("n") > hot).select("fp").distinct(), "simhash-hot")
    wide = without_two(hot_f)
    least = wide.groupBy("m", "rest").agg(F.min("fp").alias("dst"), F.max("fp").alias("top"))
    star = (wide.join(least.where("dst < top").hint("merge"), ["m", "rest"]).where("fp <> dst")
            .select(F.col("fp").alias("src"), "dst"))
    return two_of.unionByName(pairs).unionByName(star).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable, for all nodes of edges.

    Large-star links every larger neighbour of a node to the least node
    around, small-star every smaller one; both are an aggregate by node and a
    join back. Each star is stored, so that a plan reads its edges twice: with
    both in one plan they were read 16 times, and the driver planned all that
    anew after every stage. It ends when no edge changes (a few rounds: the
    depth halves).
    """
    e = common.stored(edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct(), "cc")
    before = None
    for _ in range(max_rounds):
        both = _either(e, F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        up = e.where("u > v").select(F.col("v").alias("u"), F.col("u").alias("v"))
        large = up.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = common.stored(large, "cc-large")
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        e = _either(small, F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        e = common.stored(e.where("u <> v").distinct(), "cc")
        # Sums over all edges tell whether anything changed.
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _either(edges: DataFrame, *pairs: F.Column) -> DataFrame:
    """A row (u, v) for each of the ``pairs`` of each edge."""
    return edges.select(F.explode(F.array(*pairs)).alias("e")).select("e.u", "e.v")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row a document: doc_id, fingerprint (16 hex digits), component_id."""
    common.release_memory()  # what earlier steps of the same driver left
    fp = common.stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    distinct = common.stored(fp.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least")),
                             "simhash-distinct")
    comp = components(links(distinct.select("fp")))
    named = distinct.join(comp, distinct["fp"] == comp["node"], "left").select(
        "fp", "n", "least", F.coalesce("root", "fp").alias("root"))
    named = common.stored(named, "simhash-roots")
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("docs"))
    # Roots with many fingerprints and fingerprints with many documents are
    # hot keys; both joins salt them.
    members = named.groupBy("root").agg(F.count(F.lit(1)).alias("k"))
    of_fp = common.salted_join(named, ids.drop("docs"), "root", common.heavy_keys(members, "root", "k"), "fp", "inner")
    of_fp = common.stored(of_fp.select("fp", "n", "component_id"), "simhash-named")
    out = common.salted_join(fp, of_fp.drop("n"), "fp", common.heavy_keys(of_fp, "fp", "n"), "doc_id", "inner")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
