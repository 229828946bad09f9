"""Where collections live: a table, a Parquet path, or a name below a root folder."""

from __future__ import annotations

import json
import re
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

from ..operators.project import simple_match

VERSION = "v="
LAYOUT = "_layout.json"  # a leading underscore hides it from Parquet readers


def fs_path(spark: SparkSession, path: str):
    """Hadoop path and file system of ``path``, so that any store Spark can write works."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified_uri(spark: SparkSession, path: str) -> str:
    """The path as ``_metadata.file_path`` begins for files below it."""
    hadoop, fs = fs_path(spark, path)
    return fs.makeQualified(hadoop).toUri().toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop, fs = fs_path(spark, path)
    return fs.exists(hadoop)


def literal(path: str) -> str:
    """A path for Spark's readers, which take some signs for patterns, that means just this path."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob. The listing stays in the JVM and comes back as one text, so a folder of very
    many files costs no call per file."""
    _, fs = fs_path(spark, pattern)
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(pattern))
    if found is None or len(found) == 0:
        return []
    paths = spark._jvm.java.util.List.of(spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found))
    text = spark._jvm.java.util.Arrays.deepToString(paths.toArray())[2:-2]  # path, path, ...
    scheme = text.split(":", 1)[0] + ":"
    return sorted(scheme + p for p in text.removeprefix(scheme).split(f", {scheme}"))


def children(spark: SparkSession, path: str, pattern: str = "*") -> list[str]:
    """Names below a folder that match a glob."""
    return [p.rsplit("/", 1)[1] for p in glob_paths(spark, f"{literal(path)}/{pattern}")]


def finished(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Names of folders that Spark has finished writing: it puts ``_SUCCESS`` there last."""
    return [p.rsplit("/", 2)[1] for p in glob_paths(spark, f"{literal(path)}/{pattern}/_SUCCESS")]


def is_directory(spark: SparkSession, path: str) -> bool:
    hadoop, fs = fs_path(spark, path)
    return fs.exists(hadoop) and fs.getFileStatus(hadoop).isDirectory()


def version_numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[len(VERSION) :]) for n in children(spark, path, f"{VERSION}*"))


def version_path(path: str, number: int) -> str:
    return f"{path}/{VERSION}{number:06d}"


def current_version(spark: SparkSession, path: str) -> int | None:
    """Newest finished version of a saved collection."""
    return max((int(n[len(VERSION) :]) for n in finished(spark, path, f"{VERSION}*")), default=None)


def home(name: str, root: str | None) -> str:
    return f"{root.rstrip('/')}/{name}" if root else name


def _path_names(spark: SparkSession):
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils


def escaped(spark: SparkSession, name: str) -> str:
    """A name as Spark writes it into a partition folder."""
    return _path_names(spark).escapePathName(name)


def unescaped(spark: SparkSession, folder: str) -> str:
    return _path_names(spark).unescapePathName(folder)


def save_layout(spark: SparkSession, path: str, schema: T.StructType, partition_by=(), **facts) -> None:
    """Keeps the agreed schema, the partitioning and other facts beside a saved version."""
    target, fs = fs_path(spark, f"{path}/{LAYOUT}")
    out = fs.create(target, True)
    kept = {"schema": schema.jsonValue(), "partition_by": list(partition_by), **facts}
    out.write(bytearray(json.dumps(kept).encode()))
    out.close()


def read_layout(spark: SparkSession, path: str) -> dict | None:
    """What is kept beside a saved version; None for other folders of Parquet files."""
    source, fs = fs_path(spark, f"{path}/{LAYOUT}")
    if not fs.exists(source):
        return None
    stream = fs.open(source)
    kept = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    stream.close()
    return kept


def saved_layout(spark: SparkSession, path: str) -> tuple[T.StructType, list[str]] | None:
    """Schema and partitioning of a saved version."""
    kept = read_layout(spark, path)
    return (T.StructType.fromJson(kept["schema"]), kept["partition_by"]) if kept else None


def open_parquet(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a collection's folder, with the schema agreed over all its writes where one is kept. The names in
    the folders of a root that holds dynamic collections are text, whatever they look like."""
    layout = saved_layout(spark, path)
    if layout:
        return spark.read.schema(layout[0]).parquet(literal(path))
    rows = spark.read.parquet(literal(path))
    if "_index" in rows.columns and children(spark, path, "_index=*"):
        return spark.read.schema(T.StructType([*(f for f in rows.schema.fields if f.name != "_index"), T.StructField("_index", T.StringType())])).parquet(literal(path))
    return rows


def locate_collection(spark: SparkSession, name: str, root: str | None = None) -> str | None:
    """What to read for a collection: a path, ``table:name``, or ``stream:folder`` for one that a stream in that folder
    writes; None when there is none."""
    base = home(name, root)
    candidates = [base, f"{base}.parquet"] + ([f"{root.rstrip('/')}/_index={escaped(spark, name)}"] if root else [])
    for path in candidates:
        if path_exists(spark, path):
            version = current_version(spark, path)
            if version is not None:
                return version_path(path, version)
            if not version_numbers(spark, path):
                return path
    if root is not None:
        from .streamed import collection_names, is_stream

        folder = root.rstrip("/")
        if is_stream(spark, folder) and name in collection_names(spark, folder):
            return f"stream:{folder}"
    try:
        if root is None and "/" not in name and spark.catalog.tableExists(name):
            return f"table:{name}"
    except AnalysisException:
        pass
    return None


def list_collections(spark: SparkSession, root: str) -> list[str]:
    from .streamed import collection_names, is_stream

    if is_stream(spark, root.rstrip("/")):
        return collection_names(spark, root.rstrip("/"))
    names = set()
    for entry in children(spark, root):
        if entry.startswith("_index="):
            entry = unescaped(spark, entry.removeprefix("_index="))
        entry = entry.removesuffix(".parquet")
        if not entry.startswith(("_", ".")):
            names.add(entry)
    return sorted(names)


def split_names(names) -> list[str]:
    parts = names.split(",") if isinstance(names, str) else list(names)
    return [p.strip() for p in parts if p.strip()]


def is_pattern(names) -> bool:
    return any(n == "_all" or "*" in n or n[0] in "+-" for n in split_names(names))


def select_names(known: list[str], names) -> list[str]:
    """Concrete names for a list of names and ``*`` patterns, ``_all``, ``+`` to add, ``-`` to drop."""
    picked: list[str] = []
    for item in split_names(names):
        drop, pattern = item[0] == "-", item.lstrip("+-") if item[0] in "+-" else item
        pattern = "*" if pattern == "_all" else pattern
        hits = [k for k in known if simple_match(pattern, k)] if "*" in pattern else [pattern]
        if drop:
            picked = [p for p in picked if p not in hits]
        else:
            picked += [h for h in hits if h not in picked]
    return picked


def is_named(candidate: str, names) -> bool:
    """Whether the request names the candidate itself: ``_all`` and ``*`` name nothing in particular."""
    asked = split_names(names)
    dropped = {n[1:] for n in asked if n[0] == "-"}
    wanted = {n.removeprefix("+") for n in asked if n[0] != "-"}
    fits = {p for p in wanted | dropped if simple_match(p, candidate)}
    return not (wanted | dropped) & {"*", "_all"} and not fits & dropped and bool(fits & wanted)


def drop_path(spark: SparkSession, path: str) -> None:
    hadoop, fs = fs_path(spark, path)
    fs.delete(hadoop, True)


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder for intermediate tables: below the shared folder the cluster names in
    ``spark.checkpoint.dir``. Only a single-machine session without that setting gets a local one."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="shelfmark-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
