"""State and results of streams in folders, one ``lote=n`` per micro-batch.

A batch reads what batches before its own have left and overwrites its own folders, so running it again after a
failure gives the same files. Nothing is opened to learn which version is the newest.

Five ways to keep rows, by what later batches need of them:

- versions: a batch writes the whole state anew (``put``, ``before``, ``latest``, ``expire``);
- parts: a batch writes anew the parts it touches, and a pointer from every part to its newest version
  (``put_parts``, ``read_parts``, ``expire_parts``);
- rows by day: a batch adds rows under ``dia=d/lote=n`` and a reader opens the days it wants (``add_days``, ``read_days``);
- folded sums: batches are added up ten by ten, so that a reader opens few folders (``put_folded``, ``folded``);
- all versions, for outputs that are a stream themselves (``put``, ``all_versions``).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = "lote"
DAY = "dia"
_NONE = "__HIVE_DEFAULT_PARTITION__"
#: Folders of a level that are added up into one of the next.
FAN = 10


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _exists(spark: SparkSession, path: str) -> bool:
    place, system = _folder(spark, path)
    return system.exists(place)


def _delete(spark: SparkSession, path: str) -> None:
    place, system = _folder(spark, path)
    system.delete(place, True)


def _names(spark: SparkSession, folder: str, column: str) -> list[str]:
    """Values of the folders ``column=value`` in a folder."""
    place, system = _folder(spark, folder)
    if not system.exists(place):
        return []
    names = [s.getPath().getName() for s in system.listStatus(place)]
    return [n.partition("=")[2] for n in names if n.startswith(f"{column}=")]


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete versions, oldest first."""
    numbers = map(int, _names(spark, folder, VERSION))
    return sorted(n for n in numbers if _exists(spark, f"{folder}/{VERSION}={n}/_SUCCESS"))


def start(spark: SparkSession, folder: str, batch_id: int) -> None:
    """Refuse a first batch over a state that an earlier stream has left."""
    if batch_id == 0 and any(n > 0 for n in versions(spark, folder)):
        raise ValueError(f"{folder} holds the state of another stream: give a new folder or its checkpoint")


# -- versions --------------------------------------------------------------------------------------

def put(df: DataFrame, folder: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{folder}/{VERSION}={batch_id}")


def before(spark: SparkSession, folder: str, batch_id: int, schema: T.StructType | str) -> DataFrame:
    """The newest version older than a batch; nothing before the first."""
    older = [n for n in versions(spark, folder) if n < batch_id]
    if not older:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/{VERSION}={older[-1]}")


def latest(spark: SparkSession, folder: str) -> DataFrame:
    """The newest version."""
    return spark.read.parquet(f"{folder}/{VERSION}={versions(spark, folder)[-1]}")


def expire(spark: SparkSession, folder: str, batch_id: int, keep: int = 2) -> None:
    """Delete whole versions that no repeated batch can need: all but the last ``keep``."""
    for n in versions(spark, folder):
        if n <= batch_id - keep:
            _delete(spark, f"{folder}/{VERSION}={n}")


def all_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every version, for outputs that are never replaced."""
    return spark.read.parquet(folder).drop(VERSION)


# -- parts: each at its newest version -------------------------------------------------------------
#
# ``dados/lote=n/part=value`` holds what batch n wrote, ``ponteiros/lote=n`` the batch that wrote each part last, in one
# small file. The pointers of a batch are written after its rows: they tell that it is complete.

def _pointers(spark: SparkSession, folder: str, below: int | None = None) -> dict[str, int]:
    """The part values, as folder names, with the batch that wrote each last."""
    numbers = [n for n in versions(spark, f"{folder}/ponteiros") if below is None or n < below]
    return _pointers_of(spark, folder, numbers[-1]) if numbers else {}


def _pointers_of(spark: SparkSession, folder: str, batch_id: int) -> dict[str, int]:
    place, system = _folder(spark, f"{folder}/ponteiros/{VERSION}={batch_id}/mapa.json")
    stream = system.open(place)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _put_pointers(spark: SparkSession, folder: str, batch_id: int, pointers: dict[str, int]) -> None:
    """One small file, a number per part, written by the driver; the mark that it is whole comes last."""
    at = f"{folder}/ponteiros/{VERSION}={batch_id}"
    for name, text in (("mapa.json", json.dumps(pointers)), ("_SUCCESS", "")):
        place, system = _folder(spark, f"{at}/{name}")
        stream = system.create(place, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()


def _name(value: object) -> str:
    return _NONE if value is None else str(value)


def values_of(df: DataFrame, column: str) -> list:
    """The distinct values of a column that names parts: few, such as the days of a batch."""
    return [r[0] for r in df.select(column).distinct().collect()]


def put_parts(df: DataFrame, folder: str, batch_id: int, by: str, touched: Iterable) -> None:
    """Write the touched parts anew and point to them; the other parts stay with the versions they have."""
    pointers = _pointers(df.sparkSession, folder, batch_id) | {_name(v): batch_id for v in touched}
    df.write.mode("overwrite").partitionBy(by).parquet(f"{folder}/dados/{VERSION}={batch_id}")
    found = set(_names(df.sparkSession, f"{folder}/dados/{VERSION}={batch_id}", by))
    _put_pointers(df.sparkSession, folder, batch_id, {p: n for p, n in pointers.items() if n != batch_id or p in found})


def read_parts(spark: SparkSession, folder: str, schema: T.StructType, by: str, values: Iterable | None = None,
               below: int | None = None) -> DataFrame:
    """The parts wanted (all by default) as they stood before a batch; only their files are opened."""
    pointers = _pointers(spark, folder, below)
    wanted = pointers if values is None else [p for p in map(_name, values) if p in pointers]
    if not wanted:
        return spark.createDataFrame([], schema)
    paths = [f"{folder}/dados/{VERSION}={pointers[p]}/{by}={p}" for p in wanted]
    return _read(spark, f"{folder}/dados", schema, paths).select(*schema.names)


def _read(spark: SparkSession, base: str, schema: T.StructType, paths: list[str]) -> DataFrame:
    every = T.StructType([*schema.fields, T.StructField(VERSION, T.IntegerType())])
    return spark.read.schema(every).option("basePath", base).parquet(*paths)


def expire_parts(spark: SparkSession, folder: str, batch_id: int, by: str, keep: int = 2) -> None:
    """Delete the versions of parts that the last ``keep`` batches do not point to."""
    numbers = versions(spark, f"{folder}/ponteiros")
    old = [n for n in numbers if n <= batch_id - keep]
    if not old:
        return
    needed = {(p, n) for k in numbers if k not in old for p, n in _pointers_of(spark, folder, k).items()}
    still = {n for _, n in needed}
    gone = {(p, n) for k in old for p, n in _pointers_of(spark, folder, k).items()} - needed
    for part, n in gone:
        if n in still:
            _delete(spark, f"{folder}/dados/{VERSION}={n}/{by}={part}")
    for n in {n for _, n in gone} - still:
        _delete(spark, f"{folder}/dados/{VERSION}={n}")
    for n in old:
        _delete(spark, f"{folder}/ponteiros/{VERSION}={n}")


# -- rows by day -----------------------------------------------------------------------------------

def add_days(df: DataFrame, folder: str, batch_id: int) -> None:
    """Add a batch's rows under their days; a repeated batch replaces what it added."""
    _folder(df.sparkSession, folder)[1].mkdirs(_folder(df.sparkSession, folder)[0])
    df.withColumn(VERSION, F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        DAY, VERSION).parquet(folder)


def read_days(spark: SparkSession, folder: str, schema: T.StructType | str, days: Iterable[date] | None = None,
              upto: int | None = None) -> DataFrame:
    """Rows of the days wanted (all by default) with their ``lote``, of batches up to a number; only those folders are listed."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    known = set(_names(spark, folder, DAY))
    wanted = known if days is None else {_name(d) for d in days} & known
    if not wanted:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(VERSION, T.IntegerType())]))
    found = _read(spark, folder, schema, [f"{folder}/{DAY}={d}" for d in sorted(wanted)])
    return found if upto is None else found.filter(F.col(VERSION) <= upto)


# -- folded sums -----------------------------------------------------------------------------------

def _blocks(batches: int) -> list[tuple[int, int]]:
    """(level, last batch) of the folders that together hold so many batches: those of the highest level first."""
    out, done, level = [], 0, 0
    while FAN ** (level + 1) <= batches:
        level += 1
    for k in range(level, -1, -1):
        while done + FAN**k <= batches:
            done += FAN**k
            out.append((k, done - 1))
    return out


def _block(folder: str, block: tuple[int, int]) -> str:
    return f"{folder}/nivel={block[0]}/{VERSION}={block[1]}"


def put_folded(df: DataFrame, folder: str, batch_id: int, add: Callable[[DataFrame], DataFrame]) -> None:
    """Write a batch's sums; every tenth batch adds up the last ten folders of its level, and so on upward.

    ``add`` adds up the rows of several batches, exactly, to rows of the same columns.
    """
    spark = df.sparkSession
    put(df, f"{folder}/nivel=0", batch_id)
    level = 0
    while (batch_id + 1) % FAN ** (level + 1) == 0:
        ten = [_block(folder, (level, batch_id - k * FAN**level)) for k in range(FAN)]
        put(add(spark.read.schema(df.schema).parquet(*ten)), f"{folder}/nivel={level + 1}", batch_id)
        level += 1
    # what neither this batch, run again, nor a reader needs
    needed = {*_blocks(batch_id + 1), *_blocks(batch_id), (0, batch_id)}
    for k in map(int, _names(spark, folder, "nivel")):
        for n in versions(spark, f"{folder}/nivel={k}"):
            if (k, n) not in needed:
                _delete(spark, _block(folder, (k, n)))


def folded(spark: SparkSession, folder: str) -> DataFrame:
    """The sums of all complete batches, some per folder; at most nine folders of each level are read."""
    for n in reversed(versions(spark, f"{folder}/nivel=0")):
        paths = [_block(folder, block) for block in _blocks(n + 1)]
        if all(_exists(spark, f"{path}/_SUCCESS") for path in paths):
            return spark.read.parquet(*paths)
    raise ValueError(f"{folder} holds no sums yet")
