"""Data preparation: channels in, replayed and packed records out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.operators.dimensions import lookup_labels
from wattloom.operators.quality import MAX_GAP, clean_days, common_days, days_of_all
from wattloom.operators.readings import pack_readings, record_of_each_house
from wattloom.operators.replicate import CALENDAR_DAYS, replicate_days
from wattloom.schema import HOUSES_COLUMN

# The channels whose clean days are intersected.
MAINS_CHANNEL = "1"
APPLIANCE_CHANNEL = "3"

# Fixed value: parts in which the records of a recipe are handed to its houses, so that a source of many houses has many tasks.
RECIPE_PARTS = 64

# Fixed value: houses in a list that shares a record. What a record costs once is spread over so many.
HOUSE_BLOCK = 1_024


def clean_days_of(channels: DataFrame, anchor: Column | int, max_gap: int = MAX_GAP) -> DataFrame:
    """Days of each house that are clean on its first mains and its first appliance channel."""
    mains, appliance = (
        clean_days(channels.where(F.col("meter_id") == channel), ("house_id",), anchor, max_gap)
        for channel in (MAINS_CHANNEL, APPLIANCE_CHANNEL)
    )
    return common_days(mains, appliance)


def clean_days_of_all(channels: DataFrame, anchor: Column | int, max_gap: int = MAX_GAP) -> DataFrame:
    """Days of each house that are clean on all channels it has."""
    known = channels.where(F.col("ts") >= (F.lit(anchor) if isinstance(anchor, int) else anchor))
    return days_of_all(clean_days(channels, anchor=anchor, max_gap=max_gap), known, anchor=anchor)


def _recipes(houses: DataFrame, scaled: bool) -> DataFrame:
    """The recipe of each (house_id, zip): the sources it replays, with their scale if that counts, and how often each."""
    term = ["source_house", "scale"] if scaled else ["source_house"]
    terms = houses.where("source_house IS NOT NULL").groupBy("house_id", "zip", *term).agg(F.count(F.lit(1)).cast("int").alias("times"))
    return terms.groupBy("house_id", "zip").agg(F.sort_array(F.collect_list(F.struct(*term, "times"))).alias("recipe"))


def _house_blocks(recipes: DataFrame, firsts: DataFrame) -> DataFrame:
    """(first, houses): the houses of each recipe, named by its first one, in lists of about HOUSE_BLOCK."""
    n_blocks = F.ceil(F.col("n_houses") / F.lit(HOUSE_BLOCK))
    dealt = recipes.join(firsts, "recipe").withColumn("block", F.pmod(F.xxhash64("house_id", "zip"), n_blocks))
    house = F.struct(F.col("house_id").alias("houseId"), "zip")
    return dealt.groupBy("first", "block").agg(F.sort_array(F.collect_list(house)).alias(HOUSES_COLUMN))


def _to_houses(records: DataFrame, blocks: DataFrame) -> DataFrame:
    """``records``, whose house and zip are those of the ``first`` house, shared by each block of houses; no record is shuffled after that.

    Both sides are dealt to as many tasks whatever their size, since what comes of them is their product. Their keys are of one
    type down to what may be null; else the join would cast and deal them again, to as few tasks as their bytes fill.
    """
    kinds = dict(records.dtypes)
    key_type = f"struct<first:struct<house_id:{kinds['houseId']},zip:{kinds['zip']}>,part:bigint>"
    part = F.pmod(F.xxhash64("step_start", "layer", "record_no"), F.lit(RECIPE_PARTS))
    parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(RECIPE_PARTS - 1).cast("bigint")))
    first = F.struct(F.col("houseId").alias("house_id"), "zip")
    own = [c for c in records.columns if c not in ("houseId", "zip")]
    packed = records.select(*own, F.struct(first.alias("first"), part.alias("part")).cast(key_type).alias("key"))
    lists = blocks.select(HOUSES_COLUMN, "first", parts.alias("part")).select(HOUSES_COLUMN, F.struct("first", "part").cast(key_type).alias("key"))
    packed, lists = (side.repartition(4 * RECIPE_PARTS, "key") for side in (packed, lists))
    return packed.join(lists, "key").select(*own, HOUSES_COLUMN)


def replay_records(
    channels: DataFrame,
    clean: DataFrame,
    labels: DataFrame,
    houses: DataFrame,
    days: int = CALENDAR_DAYS,
    shift: Column | int = 0,
    scaled: bool = False,
    shared: bool = False,
) -> DataFrame:
    """Compact records of the given houses, each replaying the clean days of its source house.

    ``channels`` and ``clean`` are keyed by source house (as ``house_id``), ``labels`` by
    ``source_house``. ``scaled`` applies the scale of the house to its power.

    Houses that replay the same differ in name and zip only, so records are packed once, for the first of
    them, and handed to the others as they are: what is shuffled grows with the channels and with the houses, not with
    their product. With ``scaled`` that holds for houses of one source and scale. ``shared`` leaves them in that form, a
    record with the list of its houses, for :func:`expand_readings`, which then reads each text once and not once a house.
    """
    replayed = replicate_days(channels, clean, days=days, shift=shift).withColumnRenamed("house_id", "source_house")
    labelled = lookup_labels(replayed, labels, ("source_house", "meter_id"))
    recipes = _recipes(houses, scaled)
    firsts = recipes.groupBy("recipe").agg(
        F.min(F.struct("house_id", "zip")).alias("first"), F.count(F.lit(1)).alias("n_houses")
    )
    packed_for = firsts.select("first.*", F.explode("recipe").alias("term")).select("house_id", "zip", "term.*")
    copies = packed_for.withColumn("copy", F.explode(F.sequence(F.lit(1), "times")))
    flat = labelled.join(copies, "source_house").withColumn(
        "power", F.col("power") * F.col("scale") if scaled else F.col("power")
    )
    records = pack_readings(flat.select("house_id", "ts", "zip", "label", "meter_id", "power"))
    of_many = _to_houses(records, _house_blocks(recipes, firsts))
    return of_many if shared else record_of_each_house(of_many).select(*records.columns)
