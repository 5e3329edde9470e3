"""Visa checklists. Requests: request_id, user_id, country_id, visa_id, identity; toggles: user_id, item_id, ts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import half_up
from ..sources import catalogs as cat


#: The items of all visas in catalog order: each has its bit in a user's mask.
ITEMS = [r[4] for r in cat.flat_visa_rows()]
if len(ITEMS) > 63:
    raise ValueError("a mask has 63 bits")


def item_bit(item: Column) -> Column:
    """The bit of an item, as a long; 0 for no item of the catalog."""
    bits = F.create_map(*[x for k, i in enumerate(ITEMS) for x in (F.lit(i), F.lit(1 << k).cast("long"))])
    return F.coalesce(F.try_element_at(bits, item), F.lit(0).cast("long"))


def visa_masks() -> dict[tuple[str, str], int]:
    """The mask of each visa's items."""
    out: dict[tuple[str, str], int] = {}
    for k, r in enumerate(cat.flat_visa_rows()):
        out[r[0], r[1]] = out.get((r[0], r[1]), 0) | 1 << k
    return out


def visa_items(spark: SparkSession) -> DataFrame:
    """The nested catalog flattened: sections in order, items in order within them."""
    visas = cat.visa_catalog(spark).select("country_id", "country_name", F.explode("visas").alias("v"))
    out = None
    for no, section in enumerate(cat.SECTIONS):
        names = [F.col("v.visa_id").alias("visa_id"), F.lit(no).alias("section_no"), F.lit(section).alias("section")]
        part = visas.select("country_id", *names, F.posexplode(f"v.materials.{section}").alias("item_no", "i"))
        out = part if out is None else out.unionByName(part)
    return out.select("country_id", "visa_id", "section_no", "section", "item_no", F.col("i.id").alias("item_id"), "i.name", "i.required", "i.prep_time", "i.notes", "i.needs_translation")


def visa_tips(spark: SparkSession) -> DataFrame:
    visas = cat.visa_catalog(spark).select("country_id", F.explode("visas").alias("v"))
    return visas.select("country_id", F.col("v.visa_id").alias("visa_id"), F.posexplode("v.materials.tips").alias("tip_no", "tip"))


def visa_summary(spark: SparkSession) -> DataFrame:
    """What a visa's head line shows; the further fees are in the catalog but not shown."""
    visas = cat.visa_catalog(spark).select("country_id", "country_name", F.explode("visas").alias("v"))
    fee = F.col("v.fees.visa_fee")
    fees = [fee[k].alias(f"fee_{k}") for k in ("amount", "currency", "cny")]
    return visas.select("country_id", "country_name", F.col("v.visa_id").alias("visa_id"), "v.type_name", "v.description", *fees, "v.processing_time")


def visa_fees(spark: SparkSession) -> DataFrame:
    """The further fees of each visa in CNY, and all fees together; what a visa does not ask for is null."""
    visas = cat.visa_catalog(spark).select("country_id", F.explode("visas").alias("v"))
    fees = F.col("v.fees")
    cny = {"visa_fee_cny": fees["visa_fee"]["cny"], "sevis_fee_cny": fees["sevis_fee"]["cny"], "ihs_fee_cny": fees["ihs_fee"]["cny"]}
    every = sum(F.coalesce(c, F.lit(0)) for c in cny.values())
    return visas.select("country_id", F.col("v.visa_id").alias("visa_id"), *[c.alias(k) for k, c in cny.items()], every.alias("total_cny"))


def valid_visa_requests(df: DataFrame) -> DataFrame:
    """Country, visa and identity are all given; identity filters nothing else."""
    given = lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    return df.where(given("country_id") & given("visa_id") & given("identity"))


def visa_checklist(requests: DataFrame) -> DataFrame:
    """The items of each valid request's visa; an unknown visa has none."""
    return valid_visa_requests(requests).join(F.broadcast(visa_items(requests.sparkSession)), ["country_id", "visa_id"])


def checked_masks(checked: DataFrame) -> DataFrame:
    """user_id, mask: one long a user, in which the bits of what is checked are set. checked: user_id, item_id."""
    return checked.groupBy("user_id").agg(F.bit_or(item_bit(F.col("item_id"))).alias("mask"))


def mask_progress(requests: DataFrame, masks: DataFrame) -> DataFrame:
    """total, done and percent for each valid request of a known visa; items checked for other visas do not count.

    masks: user_id and mask, one row a user. What counts is found by bits, so a
    request meets one row, and the only shuffle of requests is the one by user.
    """
    catalog = requests.sparkSession.createDataFrame([(c, v, m) for (c, v), m in visa_masks().items()], "country_id string, visa_id string, visa_mask long")
    asked = valid_visa_requests(requests).select("request_id", "user_id", "country_id", "visa_id").join(F.broadcast(catalog), ["country_id", "visa_id"])
    out = asked.join(masks.select("user_id", "mask"), "user_id", "left")
    total, done = F.bit_count("visa_mask").cast("long"), F.coalesce(F.bit_count(F.col("mask").bitwiseAND(F.col("visa_mask"))), F.lit(0)).cast("long")
    out = out.select("request_id", "user_id", "country_id", "visa_id", total.alias("total"), done.alias("done"))
    percent = F.when(F.col("total") > 0, half_up(F.col("done") * F.lit(100.0) / F.col("total"))).otherwise(F.lit(0).cast("long"))
    return out.withColumn("percent", percent)


def visa_progress(requests: DataFrame, checked: DataFrame) -> DataFrame:
    """mask_progress() of what is checked, given as rows. checked: user_id, item_id."""
    return mask_progress(requests, checked_masks(checked))


def mask_json(mask: Column) -> Column:
    """The state of a mask as JSON text: what is checked, in catalog order; what is not named is not checked."""
    bits = F.array(*[F.struct(F.lit(i).alias("item"), F.lit(True).alias("checked"), F.lit(1 << k).cast("long").alias("bit")) for k, i in enumerate(ITEMS)])
    held = F.filter(bits, lambda b: mask.bitwiseAND(b["bit"]) != 0)
    return F.to_json(F.map_from_entries(F.transform(held, lambda b: F.struct(b["item"], b["checked"]))))


def read_checked(df: DataFrame, json_col: str) -> DataFrame:
    """checked: the stored state as a map; text that is no JSON object is an empty one.

    An entry that is no boolean counts as the form counts it: 0, an empty text and
    null are not checked, all else is.
    """
    # the parser passes over what follows an object; a browser's does not
    whole = F.when(F.col(json_col).rlike(r"\}\s*$"), F.col(json_col))
    state = F.try_variant_get(F.try_parse_json(whole), "$", "map<string,variant>")

    def on(_: Column, entry: Column) -> Column:
        kind = F.schema_of_variant(entry)
        number = F.try_variant_get(entry, "$", "double")
        return (
            F.when(entry.isNull() | (kind == "VOID"), F.lit(False)).when(kind == "BOOLEAN", F.try_variant_get(entry, "$", "boolean"))
            .when(kind == "STRING", F.try_variant_get(entry, "$", "string") != "")
            .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(True)).otherwise(F.coalesce(number != 0, F.lit(True)))
        )

    none = F.create_map().cast("map<string,boolean>")
    return df.withColumn("checked", F.coalesce(F.transform_values(state, on), none))


def write_checked(checked: DataFrame) -> DataFrame:
    """user_id and the state as JSON text, items in order. checked: user_id, item_id, checked."""
    pairs = F.array_sort(F.collect_list(F.struct("item_id", "checked")))
    return checked.groupBy("user_id").agg(F.to_json(F.map_from_entries(pairs)).alias("json"))
