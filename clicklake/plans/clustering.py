"""Small files of a versioned table made into larger ones, with rows that are near in several columns side by side.

Columns are cut into ranges of about equal row counts, and the bits of the range numbers are interleaved into one
number per row. Rows in the order of that number fill files whose bounds are narrow in every one of the columns, so a
filter on any of them leaves most files unread.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clicklake.sinks.versions import Dataset, Parts, Version, replaced
from clicklake.sources.listing import list_files

TARGET_BYTES = 128 << 20
_BITS = 6


def _rank(value: Column, bounds: list[float]) -> Column:
    """How many bounds a value has reached, by halving, so that a row meets only a handful of them."""
    if not bounds:
        return F.lit(0)

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < bounds[middle], between(low, middle)).otherwise(between(middle + 1, high))

    return F.when(value.isNull(), 0).otherwise(between(0, len(bounds)))


def curve(rows: DataFrame, columns: list[str], bits: int = _BITS, error: float = 0.005) -> Column:
    """The interleaved number of a row, from numbers or times; nulls are with the smallest.

    One pass over the columns finds at most ``2 ** bits - 1`` bounds each; only these come to the driver. They move
    rows between files and change nothing else.
    """
    if not columns or bits < 1 or bits * len(columns) > 62:
        raise ValueError("one column at least, and 62 bits for all of them at most")
    shares = [k / 2**bits for k in range(1, 2**bits)]
    values = [F.col(c).cast("double") for c in columns]
    found = rows.select(*(v.alias(f"c{k}") for k, v in enumerate(values)))
    found = found.approxQuantile(found.columns, shares, error)
    places = [_rank(v, sorted(set(bounds))).cast("long") for v, bounds in zip(values, found, strict=True)]
    digits = [
        F.shiftleft(F.shiftright(place, bit).bitwiseAND(F.lit(1).cast("long")), bit * len(columns) + k)
        for bit in range(bits)
        for k, place in enumerate(places)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), digits)


def small_folders(dataset: Dataset, base: Version, table: str, target_bytes: int) -> dict[str, dict[str, int]]:
    """Bytes by part and folder, of folders whose files are below half of the target on average.

    A part is left out if merging would leave it with as many files as it has.
    """
    have: Parts = base.tables.get(table, {})
    of_part = {folder: part for part, folders in have.items() for folder in folders}
    if not of_part:
        return {}
    # Sums are per folder, of which the manifest has the list as well.
    folder = F.regexp_extract("path", "/(data/[^/]+(?:/_part=[^/]+)?)/[^/]+$", 1).alias("folder")
    files = list_files(dataset.spark, f"{dataset.root}/data").groupBy(folder).agg(F.sum("length").alias("bytes"), F.count("*").alias("files"))
    found: dict[str, dict[str, int]] = {}
    count: dict[str, int] = {}
    for row in files.where(F.col("bytes") < F.col("files") * (target_bytes / 2)).collect():
        if row["folder"] in of_part:
            part = of_part[row["folder"]]
            found.setdefault(part, {})[row["folder"]] = row["bytes"]
            count[part] = count.get(part, 0) + row["files"]
    return {part: sizes for part, sizes in found.items() if count[part] > _files(sizes, target_bytes)}


def _files(sizes: dict[str, int], target_bytes: int) -> int:
    return max(1, -(-sum(sizes.values()) // target_bytes))


def cluster(
    dataset: Dataset, table: str, schema: StructType, columns: list[str], by: str | None = None, target_bytes: int = TARGET_BYTES
) -> dict[str, int]:
    """Write the small files of a table anew as a version, ordered by ``columns``; rows stay the same.

    ``by`` is the column that the table's parts are cut by. Folders with files of a good size are left alone, so
    work follows what has come since the last time. Equal places on the curve are ordered by a digest of the row: a
    url and day with a third of all rows fills as many files as it needs. Readers of older versions keep theirs.
    """
    counts = {"parts": 0, "folders": 0, "files": 0}

    def build(base: Version):
        small = small_folders(dataset, base, table, target_bytes)
        if not small:
            return None
        folders = [x for sizes in small.values() for x in sizes]
        rows = dataset.read(base, table, schema, folders)
        files = sum(_files(sizes, target_bytes) for sizes in small.values())
        counts.update(parts=len(small), folders=len(folders), files=files)
        place, tie = curve(rows, columns).alias("_place"), F.xxhash64(*schema.names).alias("_tie")
        order = [*([by] if by else []), "_place", "_tie"]
        rows = rows.select("*", place, tie).repartitionByRange(files, *order).sortWithinPartitions(*order)
        # A folder's name has the last version of its rows.
        names = [x.split("/")[1].split("-")[1] for x in folders]
        last = max((int(n) for n in names if n.isdigit()), default=0)
        made = dataset.stage(rows.drop("_place", "_tie"), f"{table}-{last}", by)
        kept = {part: [x for x in have if x not in small.get(part, {})] for part, have in base.tables[table].items()}
        return base.tables | {table: replaced({p: x for p, x in kept.items() if x}, [], made)}, base.notes

    dataset.change(build)
    return counts
