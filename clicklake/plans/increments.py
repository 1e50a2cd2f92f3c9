"""Silver and Gold that take in only what is new, in versions that a reader sees whole.

Silver notes the Bronze loads it has worked in and keeps, beside the clicks by day, which ids it has: a bitmap per
range of 32,768 ids. A new load meets only the bitmaps of its own ranges, so neither old Bronze nor old
clicks are read, and only days that get clicks get files. Ids that a source numbers one after the other take one bit
each; the bitmaps are exact, so no click is read again to make sure.

Gold reads the Silver folders made since its last version. Clicks it could not place wait by day, with all that is
needed to place them, and so do the ids of users that were not known; new members are joined with those who
wait, and only the days of those they release are written anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklake.functions.columns import date_key
from clicklake.operators import dims, facts
from clicklake.operators.silver import COPIES, clean_clicks, deduplicate_counting
from clicklake.schemas import DIM_URL, DIM_USER, FACT_CLICKS, SILVER_CLICKS, STAR_TABLES
from clicklake.session import stored
from clicklake.sinks.versions import WHOLE, Dataset, Parts, Version, added, replaced
from clicklake.sources.bronze import latest_snapshot_day, read_date_range, read_folders
from clicklake.sources.listing import list_files

#: Ranges of 32,768 ids that share a part of the index.
BUCKETS_PER_CHUNK = 1024

VERSIONED_CLICKS = T.StructType([*SILVER_CLICKS, T.StructField("day", T.IntegerType()), T.StructField("version", T.LongType())])
_IDS = T.StructType().add("chunk", T.LongType()).add("bucket", T.LongType()).add("bits", T.BinaryType())
_LOADS = T.StructType().add("unit", T.StringType()).add("mark", T.LongType())
_WAITING = T.StructType([*SILVER_CLICKS, T.StructField("day", T.IntegerType()), T.StructField("reject_reason", T.StringType())])
_OPEN = T.StructType().add("click_id", T.LongType()).add("date_key", T.IntegerType()).add("user_id", T.LongType())


def silver_dataset(spark: SparkSession, lake: str) -> Dataset:
    """Tables ``clicks`` by day, ``ids`` by chunk of ids, ``loads``."""
    return Dataset(spark, f"{lake}/silver/versions")


def gold_dataset(spark: SparkSession, lake: str) -> Dataset:
    """The star tables, ``waiting`` (rejected clicks by day) and ``open_users`` by day."""
    return Dataset(spark, f"{lake}/gold/versions")


def read_silver(spark: SparkSession, lake: str) -> DataFrame:
    """Silver clicks of the newest version."""
    silver = silver_dataset(spark, lake)
    return silver.read(silver.current(), "clicks", VERSIONED_CLICKS).select(*SILVER_CLICKS.names)


def read_gold(spark: SparkSession, lake: str) -> dict[str, DataFrame]:
    """All star tables of one version, and ``fact_rejects``."""
    gold = gold_dataset(spark, lake)
    version = gold.current()
    star = {name: gold.read(version, name, schema) for name, schema in STAR_TABLES.items()}
    rejects = gold.read(version, "waiting", _WAITING).select("click_id", "short_code", "occurred_at", "reject_reason")
    return star | {"fact_rejects": rejects}


# --- Silver --------------------------------------------------------------------------------------


def _day() -> Column:
    return date_key(F.col("occurred_at").cast("date")).alias("day")


def without_known(incoming: DataFrame, index: DataFrame) -> DataFrame:
    """Rows whose ``click_id`` is in no bitmap. A range has 32,768 ids at most, and each row one bitmap to look at."""
    known = index.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    asked = incoming.withColumns({
        "_bucket": F.bitmap_bucket_number("click_id"), "_place": F.bitmap_bit_position("click_id"),
    })
    # Byte of the place in hexadecimal, then its bit.
    is_set = "(cast(conv(hex(substring(bits, cast(_place div 8 as int) + 1, 1)), 16, 10) as int) & shiftleft(1, cast(_place % 8 as int))) <> 0"
    return asked.join(known, (F.col("_bucket") == F.col("bucket")) & F.expr(is_set), "left_anti").drop("_bucket", "_place")


def id_index(clicks: DataFrame) -> DataFrame:
    """``chunk, bucket, bits`` of the ids of some clicks."""
    bucket = F.bitmap_bucket_number("click_id").alias("bucket")
    bits = clicks.groupBy(bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("click_id")).alias("bits"))
    return bits.select(_chunk(F.col("bucket")), "bucket", "bits")


def _chunk(bucket: Column) -> Column:
    return F.floor(bucket / BUCKETS_PER_CHUNK).cast("long").alias("chunk")


def merge_clicks(silver: Dataset, base: Version, bronze: DataFrame) -> tuple[dict[str, Parts], dict[str, int]]:
    """Tables of the next version with the clicks of ``bronze`` that ``base`` does not have, and row counts.

    Of a click that comes several times one copy is kept, the first version to have it wins.
    """
    incoming = stored(deduplicate_counting(clean_clicks(bronze)).withColumn("day", _day()), "silver-incoming")
    chunks = incoming.select(_chunk(F.bitmap_bucket_number("click_id"))).distinct().collect()
    index = silver.read(base, "ids", _IDS, silver.folders(base, "ids", sorted(r["chunk"] for r in chunks)))
    fresh = without_known(incoming, index).withColumn("version", F.lit(base.number + 1).cast("long"))
    clicks = silver.stage(fresh.select(*VERSIONED_CLICKS.names).hint("rebalance", "day"), f"clicks-{base.number + 1}", "day")
    written = silver.read(base, "clicks", VERSIONED_CLICKS, [x for part in clicks.values() for x in part])
    ids = silver.stage(id_index(written).hint("rebalance", "chunk"), "ids", "chunk") if clicks else {}
    usable, distinct = incoming.agg(F.coalesce(F.sum(COPIES), F.lit(0)), F.count(F.lit(1))).first()
    tables = base.tables | {
        "clicks": added(base.tables.get("clicks", {}), clicks), "ids": added(base.tables.get("ids", {}), ids),
    }
    # Counted from the footers of what was written.
    return tables, {"usable": usable, "distinct": distinct, "silver_rows_added": written.count(), "days_touched": len(clicks)}


def units(files: DataFrame, by_file: bool = False) -> DataFrame:
    """``unit, mark``: the load folders of a listing (or its files), and a digest that changes with their content."""
    unit = F.col("path") if by_file else F.regexp_extract("path", "^(.*)/[^/]+$", 1)
    mark = F.bit_xor(F.xxhash64("path", "length", "modificationTime"))
    return files.groupBy(unit.alias("unit")).agg(mark.alias("mark"))


def silver_increment(spark: SparkSession, lake: str, folder: str | None = None, by_file: bool = False) -> dict[str, int]:
    """Work the Bronze loads that are new, or written anew, into the versioned Silver; returns row counts.

    A load is a folder of files (with ``by_file``, a file). Clicks of a load that was replaced stay. Nothing new
    makes no version. Run beside another writer, the later one starts again from the other's version.
    """
    silver = silver_dataset(spark, lake)
    source = folder or f"{lake}/bronze/clicks"
    counts = {"loads": 0, "bronze_rows": 0, "usable": 0, "distinct": 0, "silver_rows_added": 0, "days_touched": 0}

    def build(base: Version):
        have = silver.read(base, "loads", _LOADS)
        fresh = stored(units(list_files(spark, source), by_file).join(have, ["unit", "mark"], "left_anti"), "silver-loads")
        names = [r["unit"] for r in fresh.select("unit").orderBy("unit").collect()]
        if not names:
            return None
        bronze = read_folders(spark, [x if by_file else f"{x}/*.parquet" for x in names], "clicks")
        tables, made = merge_clicks(silver, base, bronze)
        counts.update(made, loads=len(names), bronze_rows=bronze.count())
        loads = added(base.tables.get("loads", {}), silver.stage(fresh.coalesce(1), "loads"))
        if len(loads[WHOLE]) > 16:
            loads = silver.stage(have.unionByName(fresh).coalesce(1), "loads")
        return tables | {"loads": loads}, base.notes

    silver.change(build)
    return counts


# --- Gold ----------------------------------------------------------------------------------------


def _since(silver: Dataset, version: Version, seen: int) -> list[str]:
    """Folders of clicks with rows newer than a version; a folder's name has the last version of its rows."""
    every = [x for part in version.tables.get("clicks", {}).values() for x in part]
    return [x for x in every if int(x.split("/")[1].split("-")[1]) > seen]


def gold_increment(spark: SparkSession, lake: str, broadcast_bytes: int | None = None) -> dict[str, int]:
    """Work new Silver clicks and new snapshots of urls and users into the versioned star; returns counts.

    Dimension keys stay as they were given. Clicks of unknown urls wait and are placed once a url with their
    code comes; facts of users that were unknown get their key once the user comes. A url that takes another
    code later leaves the facts it has. Silver must be the versioned one.
    """
    gold, silver, bronze = gold_dataset(spark, lake), silver_dataset(spark, lake), f"{lake}/bronze"
    counts = {"clicks": 0, "released": 0, "users_found": 0, "days_rewritten": 0}

    def build(base: Version):
        state, seen = silver.current(), base.notes.get("silver", 0)
        done = base.notes.get("days", {})
        newest = {table: latest_snapshot_day(spark, bronze, table) for table in ("urls", "users")}
        urls, users = (read_date_range(spark, bronze, t, done.get(t, "0001-01-01"), day) for t, day in newest.items())
        old = {name: gold.read(base, name, schema) for name, schema in STAR_TABLES.items()}
        tables = dict(base.tables)

        def put(name: str, rows: DataFrame) -> DataFrame:
            tables[name] = gold.stage(rows, name)
            return gold.read(base, name, STAR_TABLES[name], tables[name][WHOLE])

        def before(name: str) -> DataFrame | None:
            return old[name].drop("row_loaded_at") if name in base.tables else None

        star = {
            "dim_date": old["dim_date"] if "dim_date" in base.tables else put("dim_date", dims.calendar(spark).coalesce(1)),
            "dim_device": old["dim_device"] if "dim_device" in base.tables else put("dim_device", dims.devices(spark).coalesce(1)),
            "dim_url": put("dim_url", dims.stamped(dims.dim_url(urls, before("dim_url"), ["ingestion_date"]), DIM_URL)),
            "dim_user": put("dim_user", dims.stamped(dims.dim_user(users, before("dim_user"), ["ingestion_date"]), DIM_USER)),
        }

        # Clicks that came, and those that waited for a code that has come.
        came = silver.read(state, "clicks", VERSIONED_CLICKS, _since(silver, state, seen))
        came = came.where(F.col("version") > seen).select(*SILVER_CLICKS.names)
        codes = star["dim_url"].select("short_code").where("short_code IS NOT NULL").distinct()
        codes = stored(codes.join(old["dim_url"].select("short_code"), "short_code", "left_anti"), "gold-codes")
        waiting = gold.read(base, "waiting", _WAITING)
        released = stored(waiting.where("reject_reason = 'unknown_url'").join(codes, "short_code", "left_semi").select(*_WAITING.names), "gold-released")
        kept = ["user_id", "device_type", "hashed_ip", "silver_loaded_at"]
        resolved = facts.resolve_clicks(
            came.unionByName(released.select(*SILVER_CLICKS.names)), star["dim_date"], star["dim_url"], star["dim_user"],
            star["dim_device"], broadcast_bytes, kept,
        )
        resolved = stored(resolved.withColumn("day", _day()), "gold-resolved")
        placed = resolved.where("reject_reason IS NULL")
        fact = placed.withColumn("row_loaded_at", F.current_timestamp()).select(*FACT_CLICKS.names)
        new_facts = gold.stage(fact.hint("rebalance", "date_key"), "fact_clicks", "date_key")
        new_open = gold.stage(placed.where("user_unresolved").select(*_OPEN.names).hint("rebalance", "date_key"), "open_users", "date_key")
        new_waiting = gold.stage(resolved.where("reject_reason IS NOT NULL").select(*_WAITING.names).hint("rebalance", "day"), "waiting", "day")

        # Days whose waiting clicks were released are written without them.
        days = [r["day"] for r in released.select("day").distinct().collect()]
        rest = gold.read(base, "waiting", _WAITING, gold.folders(base, "waiting", days)).join(released.select("click_id"), "click_id", "left_anti")
        left = gold.stage(rest.select(*_WAITING.names).hint("rebalance", "day"), "waiting", "day") if days else {}
        tables["waiting"] = added(replaced(base.tables.get("waiting", {}), map(str, days), left), new_waiting)

        # Facts of users that have come get their key; a day is written anew only if it has some.
        people = star["dim_user"].where("is_known").select("user_id", "user_key").join(old["dim_user"].select("user_id"), "user_id", "left_anti")
        found = gold.read(base, "open_users", _OPEN).join(people, "user_id").select("click_id", "date_key", F.col("user_key").alias("_key"))
        found = stored(found, "gold-found")
        hit = [r["date_key"] for r in found.select("date_key").distinct().collect()]
        mended, shut = {}, {}
        if hit:
            facts_hit = gold.read(base, "fact_clicks", FACT_CLICKS, gold.folders(base, "fact_clicks", hit))
            mended_rows = facts_hit.join(found.select("click_id", "_key"), "click_id", "left").withColumn("user_key", F.coalesce("_key", "user_key"))
            mended = gold.stage(mended_rows.select(*FACT_CLICKS.names).hint("rebalance", "date_key"), "fact_clicks", "date_key")
            still = gold.read(base, "open_users", _OPEN, gold.folders(base, "open_users", hit)).join(found.select("click_id"), "click_id", "left_anti")
            shut = gold.stage(still.select(*_OPEN.names).hint("rebalance", "date_key"), "open_users", "date_key")
        tables["fact_clicks"] = added(replaced(base.tables.get("fact_clicks", {}), map(str, hit), mended), new_facts)
        tables["open_users"] = added(replaced(base.tables.get("open_users", {}), map(str, hit), shut), new_open)
        counts.update(clicks=came.count(), released=released.count(), users_found=found.count(), days_rewritten=len(hit))
        return tables, {"silver": state.number, "days": newest}

    gold.change(build)
    return counts


# --- Upkeep --------------------------------------------------------------------------------------


def compact(dataset: Dataset, table: str, schema: T.StructType, by: str, max_folders: int = 8, order: list[str] | None = None) -> int:
    """Write parts of more than ``max_folders`` folders into one each; returns how many. Rows stay the same."""
    done = 0

    def build(base: Version):
        nonlocal done
        have = base.tables.get(table, {})
        many = {part: folders for part, folders in have.items() if len(folders) > max_folders}
        done = len(many)
        if not many:
            return None
        last = max(int(x) if x.isdigit() else 0 for folders in many.values() for f in folders for x in [f.split("/")[1].split("-")[1]])
        rows = dataset.read(base, table, schema, [x for folders in many.values() for x in folders]).hint("rebalance", by)
        rows = rows.sortWithinPartitions(by, *order) if order else rows
        return base.tables | {table: replaced(have, many, dataset.stage(rows, f"{table}-{last}", by))}, base.notes

    dataset.change(build)
    return done
