"""Sharding by a hierarchical weighted hash tree, and the shard files.

The tree has regions, racks and slots; shard ``i`` sits in a slot.  An id is placed by a descent: at each level every
child draws ``-ln(u) / weight`` from a hash of the id, the descent's number and the child's path, and the smallest draw wins, so a
child is taken in proportion to its weight.  Regions and racks draw with the weight that is reserved below them, a slot
with its own reserve; the slot then admits the id with the chance ``weight of its shard / reserve``, by one more draw.  An
id that is not admitted (empty slot, shard of less weight) descends again under the next number.  No draw above a
shard depends on that shard, so

* a shard that is added, or gains weight, only takes ids into itself, from everywhere alike;
* a shard that leaves, or loses weight, only gives its own ids away;
* a reserve that changes (a new region, a larger rack) changes draws only towards or away from the subtrees that hold it; an id drawn
  there and not admitted goes on to its next descent.

After ``DESCENTS`` refused descents (chance ``(1 - filled share) ** DESCENTS``) the smallest draw among the shards themselves
decides, which keeps these rules.  Only the id and the shards' weights enter: equal ids, also all null ones (they count
as the empty text), share a shard however many rows they have.

``write_shards`` range-partitions whole rows by (shard, id, hash of the text, place in the input), so a shard, an id or a text that
holds a third of all rows is spread over many tasks, and writes every shard as files of about ``file_bytes``, in that
order.  ``read_shards`` numbers the rows: a file's first slot is the sum of the row counts of the shard's earlier files, so
no task ever holds a shard.

Rows: a null text has no bytes; repeated rows are all kept and get slots of their own; an empty table gives no rows.  Any other
columns are kept as they are: a row is stored as one struct, so that no column name can clash.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

DESCENTS = 64
_HALF = 1 << 52


@dataclass(frozen=True)
class Tree:
    """``shape``: regions, racks in each, slots in each.  Shard ``i`` goes to region ``i mod regions``, then to its racks in turn.

    ``weights``: weight of a shard, 1 where not stated and never above its slot's reserve; ``reserves``: reserve of a slot
    ``(region, rack, slot)``, 1 where not stated."""

    shards: int
    shape: tuple[int, int, int] = (4, 4, 4)
    weights: dict[int, float] = field(default_factory=dict)
    reserves: dict[tuple[int, int, int], float] = field(default_factory=dict)

    def __post_init__(self):
        if not 0 < self.shards <= self.shape[0] * self.shape[1] * self.shape[2]:
            raise ValueError(f"{self.shards} shards don't fit a tree of shape {self.shape}: reserve more slots")
        for i in range(self.shards):
            if not 0 <= self.weight(i) <= self.reserve(*self.slot_of(i)):
                raise ValueError(f"shard {i}: its weight exceeds its slot's reserve")
        if not any(self.weight(i) for i in range(self.shards)):
            raise ValueError("no shard has a weight")

    def slot_of(self, shard: int) -> tuple[int, int, int]:
        regions, racks, _ = self.shape
        return shard % regions, shard // regions % racks, shard // (regions * racks)

    def shard_in(self, region: int, rack: int, slot: int) -> int | None:
        shard = (slot * self.shape[1] + rack) * self.shape[0] + region
        return shard if shard < self.shards else None

    def weight(self, shard: int) -> float:
        return float(self.weights.get(shard, 1.0))

    def reserve(self, region: int, rack: int | None = None, slot: int | None = None) -> float:
        """Reserved weight of a region, a rack or a slot."""
        if rack is None:
            return sum(self.reserve(region, k) for k in range(self.shape[1]))
        if slot is None:
            return sum(self.reserve(region, rack, s) for s in range(self.shape[2]))
        return float(self.reserves.get((region, rack, slot), 1.0))


def _unit(*parts) -> Column:
    """A number between 0 and 1, ends excluded, from a hash of the parts."""
    text = F.concat_ws(":", *(p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") + 0.5) / F.lit(float(_HALF))


def _least(draws: list[tuple[Column, Column, int]]) -> Column:
    """The number whose draw ``-ln(u) / weight`` is the smallest; a child without weight never is."""
    scored = [F.struct(F.when(w > 0, -F.ln(u) / w).otherwise(F.lit(float("inf"))).alias("s"), F.lit(i).alias("i")) for u, w, i in draws]
    return F.array_min(F.array(*scored))["i"]


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _table(values) -> Column:
    return F.array(*(F.lit(v) for v in values))


def shard_of(id_col: Column, tree: Tree) -> Column:
    """The shard of an id."""
    regions, racks, slots = tree.shape
    key = F.coalesce(id_col.cast("string"), F.lit(""))
    region_w = [tree.reserve(r) for r in range(regions)]
    rack_w = _table([tree.reserve(r, k) for r in range(regions) for k in range(racks)])
    slot_w = _table([tree.reserve(r, k, s) for r in range(regions) for k in range(racks) for s in range(slots)])
    places = [(r, k, s, tree.shard_in(r, k, s)) for r in range(regions) for k in range(racks) for s in range(slots)]
    shard_at = _table([-1 if i is None else i for *_, i in places])
    admits = _table([0.0 if i is None else tree.weight(i) / tree.reserve(r, k, s) if tree.reserve(r, k, s) else 0.0 for r, k, s, i in places])

    def at(table, place):
        return F.get(table, place)

    def admitted(t, place):
        # the last draw is skipped where it can't refuse
        p = at(admits, place)
        return F.when((p >= 1) | (_unit(key, t, "admit", at(shard_at, place)) < p), at(shard_at, place)).otherwise(F.lit(-1))

    def slot(t, r, k):
        rack = r * racks + k
        drawn = _least([(_unit(key, t, r, k, s), at(slot_w, rack * slots + s), s) for s in range(slots)])
        return _let(rack * slots + drawn, lambda place: admitted(t, place))

    def rack(t, r):
        drawn = _least([(_unit(key, t, r, k), at(rack_w, r * racks + k), k) for k in range(racks)])
        return _let(drawn, lambda k: slot(t, r, k))

    def descend(t):
        return _let(_least([(_unit(key, t, r), F.lit(region_w[r]), r) for r in range(regions)]), lambda r: rack(t, r))

    got = F.aggregate(F.sequence(F.lit(0), F.lit(DESCENTS - 1)), F.lit(-1), lambda a, t: F.when(a >= 0, a).otherwise(descend(t)))
    last = _least([(_unit(key, "last", i), F.lit(tree.weight(i)), i) for i in range(tree.shards)])
    return _let(got, lambda g: F.when(g >= 0, g).otherwise(last)).cast("int")


def row_size(text: Column) -> Column:
    """UTF-8 bytes of the text plus 16."""
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 16).cast("long")


def write_shards(spark: SparkSession, docs: DataFrame, path: str, tree: Tree, id_col: str = "doc_id", text_col: str = "text",
                 file_bytes: int = 64 << 20) -> None:
    """Write all rows to ``path/shard=.../part=...``, whole rows in struct ``row``, files of about ``file_bytes`` of text."""
    total = docs.agg(F.sum(row_size(F.col(text_col)))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // file_bytes + 1)
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    row = row.select("row", shard_of(F.col("row")[id_col], tree).alias("shard"), F.xxhash64(F.col("row")[text_col]).alias("text_hash"),
                     F.monotonically_increasing_id().alias("place"))
    order = ["shard", F.col("row")[id_col], "text_hash", "place"]
    dealt = row.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    (dealt.select("row", "shard", F.spark_partition_id().alias("part")).write.partitionBy("shard", "part")
     .option("maxRecordsPerFile", 0).parquet(path))


def read_shards(spark: SparkSession, path: str, row_type: StructType) -> DataFrame:
    """``row``, ``shard`` and ``slot`` of every stored row; ``row_type`` is the schema of the table that was written."""
    schema = StructType([StructField("row", row_type), StructField("shard", IntegerType()), StructField("part", IntegerType())])
    stored = spark.read.schema(schema).parquet(path)
    files = stored.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("rows"))
    # sums over blocks of 1,000 files first, so that no window holds more than a thousandth of a shard's files
    files = files.withColumn("block", F.floor(F.col("part") / 1000))
    blocks = files.groupBy("shard", "block").agg(F.sum("rows").alias("rows"))
    before = lambda *keys, by: F.coalesce(
        F.sum("rows").over(Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.select("shard", "block", before("shard", by="block").alias("block_first"))
    files = files.withColumn("first", before("shard", "block", by="part")).join(blocks, ["shard", "block"])
    files = files.select("shard", "part", (F.col("first") + F.col("block_first")).cast(LongType()).alias("first"))
    rows = stored.select("row", "shard", "part", F.col("_metadata.row_index").alias("at"))
    return rows.join(files, ["shard", "part"]).select("row", "shard", (F.col("first") + F.col("at")).alias("slot"))
