"""Hard negatives through angular triangle filtering.

Each row stores its angles to ``REFERENCES`` directions (centres of a spherical
k-means over a sample of ``SAMPLE`` vectors; they change the speed only). The
angle between two vectors lies between the largest difference and the smallest
sum of their angles to the same direction (triangle inequality on the sphere),
so its cosine lies in an interval, and with the norms so does the score.

Rows are dealt to blocks by their nearest direction and lie in a block by their
angle to it, cut into windows of ``WINDOW`` rows that keep the least and
greatest angle to every direction. An anchor's interval for a whole window
comes from these; angles are widened by ``ANGLE_SLACK`` and scores by a share of
the norms and one, far above any rounding. Only windows whose interval meets
what is wanted get integer scores:

1. positives: the greatest possible score reaches the last of the best so far;
2. negatives: the interval meets [low, high] of a positive's score, and its
   upper end the last of the best negatives so far.

Rows with equal vector and label are one row with its smallest ids, so a group
of copies costs as much as one row. Rows go once to their block; anchors, the
smaller side, to every block. The driver gets counts, the sample and a count
for each direction.

Defined cases: see ``vectors`` for null vectors, components and repeated ids;
rows with a null label take no part. Scores tie to the smaller id. A vector of
zeros has score 0 with all. Anchors without a positive, and positives without a
negative in their window (all with a negative score), have no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinsift.llm import common, vectors

REFERENCES = 32
SAMPLE = 4096
WINDOW = 64
ROWS_PER_BLOCK = 4096
ANCHORS_PER_BLOCK = 512
ANGLE_SLACK = 1e-6

_FOUND = pa.schema([("q", pa.int64()), ("w", pa.int64()), ("r", pa.int64()), ("s", pa.int64())])
_FOUND_DDL = "q long, w long, r long, s long"


def mine(df: DataFrame, id_col: str, vec_col: str, label_col: str | Column, is_anchor: Column, positives: int = 5, negatives: int = 3,
         low: int = 50, high: int = 95, references: int = REFERENCES, rows_per_block: int = ROWS_PER_BLOCK,
         anchors_per_block: int = ANCHORS_PER_BLOCK, window: int = WINDOW) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for each anchor (``is_anchor`` is a condition on ``id``)
    and each of its ``positives`` best rows of the same label the ``negatives``
    best rows of other labels with low% to high% of the positive's score."""
    label = F.col(label_col) if isinstance(label_col, str) else label_col
    rows = vectors.integer_rows(df.where(label.isNotNull()), id_col, vec_col, label=label.cast("string"))
    groups, members = _distinct(rows, max(positives + 1, negatives))
    n, dim, most = vectors.shape(groups)
    directions = reference_directions(groups, dim, references)
    table = _Table(groups, dim, most, directions, rows_per_block, window)
    asked = common.stored(members.where(is_anchor), "anchor-rows")
    wanted = common.stored(groups.join(asked.select("key").distinct(), "key", "left_semi"), "anchor-vectors")
    anchors = _Anchors(wanted, wanted.count(), dim, most, directions, anchors_per_block)

    # Positives of an anchor group (one more: the group may lead with the
    # anchor itself), then of each anchor.
    near = table.named(_ranked(table.search(anchors.data, positives + 1, same=True), ["q"], positives + 1))
    near = common.stored(_first(near, ["q"], positives + 1), "positive-groups")
    pos = _per_anchor(near, anchors, asked, positives)

    # A window of scores for each different score of a positive.
    span = near.select("q", F.col("s").alias("positive_score")).distinct().withColumns(
        {"lo": F.expr(_ceil_div(f"positive_score * {low}")), "hi": F.expr(_floor_div(f"positive_score * {high}"))})
    span = common.stored(span.where("lo <= hi"), "score-windows")
    by_block = (span.groupBy(vectors.block_of("q").alias("q_block")).agg(F.collect_list(F.struct("q", "positive_score", "lo", "hi")).alias("x"))
                .select("q_block", *[F.col(f"x.{a}").alias(b) for a, b in (("q", "xq"), ("positive_score", "xw"), ("lo", "xlo"), ("hi", "xhi"))]))
    far = table.search(anchors.data.join(by_block, "q_block"), negatives, same=False)
    far = _first(table.named(_ranked(far, ["q", "w"], negatives)), ["q", "w"], negatives)
    per = Window.partitionBy("q", "w").orderBy(F.desc("s"), "id")
    far = far.select("q", "w", "s", F.explode("ids").alias("id")).withColumn("rank", F.row_number().over(per)).where(F.col("rank") <= negatives)
    lists = far.groupBy("q", F.col("w").alias("positive_score")).agg(F.collect_list(F.struct("rank", F.col("id").alias("negative_id"), F.col("s").alias("negative_score"))).alias("n"))
    out = pos.join(lists, ["q", "positive_score"]).select("anchor_id", "positive_id", "positive_score", F.explode("n").alias("n"))
    return out.select("anchor_id", "positive_id", "n.rank", "n.negative_id", "positive_score", "n.negative_score")


def _floor_div(x: str) -> str:
    return f"({x}) div 100 - CASE WHEN ({x}) % 100 < 0 THEN 1 ELSE 0 END"


def _ceil_div(x: str) -> str:
    return f"({x}) div 100 + CASE WHEN ({x}) % 100 > 0 THEN 1 ELSE 0 END"


def _distinct(rows: DataFrame, m: int) -> tuple[DataFrame, DataFrame]:
    """(key, v, label, ids: the ``m`` smallest) of each different vector and
    label, and (id, key) of all rows."""
    keyed = rows.withColumn("key", F.sha2(F.to_json(F.struct("v", "label")), 256))
    w = Window.partitionBy("key").orderBy("id")
    least = keyed.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= m)
    one = F.min(F.when(F.col("_r") == 1, F.struct("v", "label"))).alias("one")
    groups = least.groupBy("key").agg(one, F.array_sort(F.collect_list("id")).alias("ids"))
    return common.stored(groups.select("key", "one.v", "one.label", "ids"), "vector-groups"), keyed.select("id", "key")


def unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length one, and the lengths."""
    norm = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
    return x / np.maximum(norm, 1e-300)[:, None], norm


def angles(x: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Of unit rows to unit directions."""
    return np.arccos(np.clip(x @ directions.T, -1.0, 1.0))


def reference_directions(groups: DataFrame, dim: int, references: int, rounds: int = 8) -> np.ndarray:
    """Centres of a spherical k-means over the ``SAMPLE`` vectors with the
    smallest keys (hashes)."""
    lists = groups.select("key", "v").orderBy("key").limit(SAMPLE).select("v").toArrow().column("v")
    x, norm = unit(vectors.matrix(vectors.one_array(lists), dim))
    x = x[norm > 0]
    if not len(x):
        return np.eye(1, dim) if dim else np.zeros((1, 0))
    centres = x[:: max(1, len(x) // references)][:references].copy()
    for _ in range(rounds):
        own = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        length = np.linalg.norm(sums, axis=1)
        centres[length > 1e-9] = sums[length > 1e-9] / length[length > 1e-9, None]
    return centres


def score_bounds(a: np.ndarray, a_norm: np.ndarray, lo: np.ndarray, hi: np.ndarray, n_lo: np.ndarray, n_hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) score of each anchor with any row of each window:
    ``a`` anchors x directions, ``lo`` and ``hi`` windows x directions (angles),
    ``n_lo`` and ``n_hi`` the windows' norms."""
    apart, far = np.zeros((len(a), len(lo))), np.full((len(a), len(lo)), np.pi)
    for j in range(a.shape[1]):
        x, l, h = a[:, j, None], lo[None, :, j], hi[None, :, j]
        np.maximum(apart, np.maximum(x - h, l - x), out=apart)
        np.minimum(far, np.minimum(x + h, 2 * np.pi - (x + l)), out=far)
    top = np.cos(np.clip(apart - ANGLE_SLACK, 0, np.pi))
    low = np.cos(np.clip(far + ANGLE_SLACK, 0, np.pi))
    scale = a_norm[:, None]
    slack = 1e-9 * scale * n_hi + 1
    greatest = scale * np.where(top >= 0, n_hi, n_lo) * top + slack
    least = scale * np.where(low >= 0, n_lo, n_hi) * low - slack
    return least, greatest


class _Anchors:
    """Blocks of anchors with their labels, angles and norms."""

    def __init__(self, wanted: DataFrame, n: int, dim: int, most: int, directions: np.ndarray, per_block: int):
        self.blocks, kind = max(1, -(-n // per_block)), vectors.kind_of(most)

        def pack(t: pa.Table) -> pa.Table:
            m = vectors.matrix(vectors.one_array(t.column("v")), dim)
            x, norm = unit(m)
            return pa.table({"q_block": pa.array([t.column("block")[0].as_py()], pa.int32()), "q_keys": pa.array([t.column("key").to_pylist()], pa.list_(pa.string())),
                             "q_labels": pa.array([t.column("label").to_pylist()], pa.list_(pa.string())),
                             "q_data": pa.array([m.astype(kind).tobytes()], pa.binary()), "q_angles": pa.array([angles(x, directions).tobytes()], pa.binary()),
                             "q_norms": pa.array([norm.tobytes()], pa.binary())})

        stored = vectors.packed(wanted.select("key", "v", "label", vectors.hash_block("key", self.blocks).alias("block")), self.blocks, pack,
                                "q_block int, q_keys array<string>, q_labels array<string>, q_data binary, q_angles binary, q_norms binary")
        self.data = stored.drop("q_keys")
        at = stored.select("q_block", F.posexplode("q_keys").alias("i", "key"))
        self.places = at.select((F.shiftleft(F.col("q_block").cast("long"), vectors.PLACE_BITS) + F.col("i")).alias("q"), "key")


class _Table:
    """Blocks of rows by nearest direction, in windows of like angles."""

    def __init__(self, groups: DataFrame, dim: int, most: int, directions: np.ndarray, per_block: int, window: int):
        kind = vectors.kind_of(most)

        def nearest(batch: pa.RecordBatch) -> pa.RecordBatch:
            x, _ = unit(vectors.matrix(batch.column(1), dim))
            own = np.argmax(x @ directions.T, axis=1).astype(np.int32)
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(own)], names=[*batch.schema.names, "ref"])

        thin = groups.select("key", "v", "label")
        dealt = common.stored(common.map_batches(thin, nearest, "key string, v array<bigint>, label string, ref int"), "by-direction")
        counts = {r["ref"]: r["n"] for r in dealt.groupBy("ref").agg(F.count(F.lit(1)).alias("n")).collect()}
        number, first = F.lit(0), 0
        for ref in sorted(counts):  # at most REFERENCES
            some = -(-counts[ref] // per_block)
            number = F.when(F.col("ref") == ref, F.lit(first) + vectors.hash_block("key", some)).otherwise(number)
            first += some
        self.blocks, self.kind, self.window, self.groups = max(1, first), kind, window, groups

        def pack(t: pa.Table) -> pa.Table:
            m = vectors.matrix(vectors.one_array(t.column("v")), dim)
            x, norm = unit(m)
            angle = angles(x, directions)
            order = np.lexsort((norm, angle[:, t.column("ref")[0].as_py()]))
            angle, norm = angle[order], norm[order]
            cuts = np.arange(0, len(m), window)
            t = t.take(pa.array(order))
            parts = {"lo": np.minimum.reduceat(angle, cuts), "hi": np.maximum.reduceat(angle, cuts),
                     "n_lo": np.minimum.reduceat(norm, cuts), "n_hi": np.maximum.reduceat(norm, cuts), "data": m[order].astype(kind)}
            return pa.table({"block": pa.array([t.column("block")[0].as_py()], pa.int32()), "keys": pa.array([t.column("key").to_pylist()], pa.list_(pa.string())),
                             "labels": pa.array([t.column("label").to_pylist()], pa.list_(pa.string())), **{c: pa.array([x.tobytes()], pa.binary()) for c, x in parts.items()}})

        self.stored = vectors.packed(dealt.withColumn("block", number.cast("int")), self.blocks, pack,
                                     "block int, keys array<string>, labels array<string>, lo binary, hi binary, n_lo binary, n_hi binary, data binary")

    def search(self, anchors: DataFrame, most: int, same: bool) -> DataFrame:
        """(q, w, r, s): in each block the ``most`` best rows, and all that tie
        with the last, of the anchor's label (``same``) or, for each of its
        score windows w, of other labels."""
        kind, window = self.kind, self.window
        return vectors.map_rows(vectors.tiles(self.stored.drop("keys"), anchors, self.blocks),
                                lambda row: _tile(row, kind, most, same, window), _FOUND, _FOUND_DDL)

    def named(self, found: DataFrame) -> DataFrame:
        """``found`` with the smallest ids of the places."""
        at = self.stored.select("block", F.posexplode("keys").alias("i", "key"))
        at = at.select((F.shiftleft(F.col("block").cast("long"), vectors.PLACE_BITS) + F.col("i")).alias("r"), "key")
        return found.join(at.join(self.groups.select("key", "ids"), "key").select("r", "ids", F.get("ids", F.lit(0)).alias("least")), "r")


def _numbers(row: dict, name: str, kind: str, width: int | None = None) -> np.ndarray:
    x = np.frombuffer(row[name].as_buffer(), kind)
    return x if width is None else x.reshape(width, -1)


def _tile(row: dict, kind: str, most: int, same: bool, window: int) -> Iterator[dict]:
    labels, q_labels = row["labels"].values, row["q_labels"].values
    n, m = len(labels), len(q_labels)
    code = pa.concat_arrays([labels, q_labels]).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    code, q_code = code[:n], code[n:]
    data, q_data = _numbers(row, "data", kind, n), _numbers(row, "q_data", kind, m)
    cuts = np.arange(0, n, window)
    least, greatest = score_bounds(_numbers(row, "q_angles", "<f8", m), _numbers(row, "q_norms", "<f8"), _numbers(row, "lo", "<f8", len(cuts)),
                                   _numbers(row, "hi", "<f8", len(cuts)), _numbers(row, "n_lo", "<f8"), _numbers(row, "n_hi", "<f8"))
    if same:  # one request an anchor: any score
        who, tag = np.arange(m), np.zeros(m, np.int64)
        lo = hi = None
    else:
        who = row["xq"].values.to_numpy() & (1 << vectors.PLACE_BITS) - 1
        tag, lo, hi = (row[x].values.to_numpy() for x in ("xw", "xlo", "xhi"))
    lowest = np.iinfo(np.int64).min
    best = np.full((len(who), most), lowest, np.int64)  # ascending in no order; column minimum is the bar
    out = []
    for w in np.argsort(-greatest.sum(axis=0)):
        bar = best.min(axis=1)
        live = greatest[who, w] >= bar
        if not same:
            live &= (greatest[who, w] >= lo) & (least[who, w] <= hi)
        ask = np.flatnonzero(live)
        if not len(ask):
            continue
        at = slice(cuts[w], cuts[w] + window)
        some, of = np.unique(who[ask], return_inverse=True)
        s = vectors.products(q_data[some], data[at])
        fits = (q_code[some][:, None] == code[at][None, :]) == same
        s, fits = s[of], fits[of] & (s[of] >= bar[ask][:, None])
        if not same:
            fits &= (s >= lo[ask][:, None]) & (s <= hi[ask][:, None])
        i, j = np.nonzero(fits)
        if not len(i):
            continue
        out.append((ask[i], cuts[w] + j, s[i, j]))
        both = np.concatenate([best[ask], np.where(fits, s, lowest)], axis=1)
        best[ask] = np.partition(both, both.shape[1] - most, axis=1)[:, -most:]
    if out:
        i, r, s = (np.concatenate(x) for x in zip(*out, strict=True))
        keep = s >= best.min(axis=1)[i]
        i, r, s = i[keep], r[keep], s[keep]
        yield {"q": vectors.places(row["q_block"].as_py(), who[i]), "w": tag[i], "r": vectors.places(row["block"].as_py(), r), "s": s}


def _ranked(found: DataFrame, per: list[str], most: int) -> DataFrame:
    """The ``most`` best of all blocks, and ties with the last."""
    w = Window.partitionBy(*per).orderBy(F.desc("s"))
    return found.withColumn("_r", F.rank().over(w)).where(F.col("_r") <= most).drop("_r")


def _first(named: DataFrame, per: list[str], most: int) -> DataFrame:
    w = Window.partitionBy(*per).orderBy(F.desc("s"), "least")
    return named.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= most).select(*per, "s", "ids")


def _per_anchor(near: DataFrame, anchors: _Anchors, asked: DataFrame, positives: int) -> DataFrame:
    """(q, anchor_id, positive_id, positive_score): the first rows of each
    anchor without itself."""
    lists = near.groupBy("q").agg(F.collect_list(F.struct("s", "ids")).alias("found")).join(anchors.places, "q")
    counts = common.stored(asked.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "anchor-counts")
    rows = common.salted_join(asked, lists, "key", common.heavy_keys(counts, "key", "n"), F.col("id"), "inner")
    one = rows.select("q", F.col("id").alias("anchor_id"), F.explode("found").alias("f")).select(
        "q", "anchor_id", F.col("f.s").alias("positive_score"), F.explode("f.ids").alias("positive_id"))
    w = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    one = one.where("anchor_id != positive_id").withColumn("_r", F.row_number().over(w))
    return one.where(F.col("_r") <= positives).drop("_r")
