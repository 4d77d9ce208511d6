"""Image files as relations: a data source that lists and reads folders, content and fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from canopyspark.sources.tables import EXPORTS, SHEETS

#: Extensions of images.
EXTENSIONS = (".jpg", ".jpeg", ".png", ".tiff", ".tif", ".webp")
#: Folders with pictures that this engine writes.
OWNED = (EXPORTS, SHEETS)
#: Errors of files.
EMPTY, UNREADABLE = "file is empty", "file could not be read"
_NAMES = ["image_key", "path", "length", "modified", "content", "error"]
_TYPES = [pa.string(), pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.binary(), pa.string()]


def extension(path: Column) -> Column:
    """The last part of the name from its dot on, in lower case; empty without one."""
    return F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))


def processable(files: DataFrame, path: str = "image_key") -> DataFrame:
    """Files with an image's extension, a name without a leading dot, and no part of the path that is one of the pipeline's own folders."""
    parts = F.split(path, "/")
    return files.where(extension(F.col(path)).isin(*EXTENSIONS) & ~F.element_at(parts, -1).startswith(".") & ~F.arrays_overlap(parts, F.array(*(F.lit(d) for d in OWNED))))


def ordered(files: DataFrame, path: str = "image_key") -> DataFrame:
    """By path, part by part rather than as one string."""
    return files.orderBy(F.split(path, "/"))


def first_with_stem(files: DataFrame, stem: str, path: str = "image_key") -> DataFrame:
    """The first file, by path, whose name without its extension is stem: one row or none."""
    name = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]+$", "")
    return ordered(files.where(name == stem), path).limit(1)


FILES = "image_key string, path string, length long, modified timestamp, content binary, error string"


def _opened(root: str) -> tuple[fs.FileSystem, str]:
    """The file system that a folder is in, and the folder's path there."""
    if root.startswith("file:"):
        return fs.LocalFileSystem(), "/" + root.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), str(Path(root).absolute()))


@dataclass
class Folder(InputPartition):
    """One folder below the root: its path, and its files' keys up to their names."""

    path: str
    prefix: str


class ImageFolders(DataSource):
    """spark.read.format("image_folders"): image_key (path below the root), path, length, modified, content and error of each processable
    image below a folder; one partition for each folder. Options: path; recursive (true); content (true), without which content is null.

    A file is listed whatever its folder's name, also without content; error tells why it can't be read. The driver holds the folders'
    names, not the files'. Folders are in any store that pyarrow opens.
    """

    @classmethod
    def name(cls) -> str:
        return "image_folders"

    def schema(self) -> str:
        return FILES

    def reader(self, schema: StructType) -> ImageReader:
        return ImageReader(self.options["path"], *(self.options.get(k, "true").lower() == "true" for k in ("recursive", "content")))


class ImageReader(DataSourceReader):
    def __init__(self, root: str, recursive: bool, content: bool):
        self.root, self.recursive, self.content = root, recursive, content

    def partitions(self) -> list[Folder]:
        store, top = _opened(self.root)
        if store.get_file_info(top).type != fs.FileType.Directory:
            raise NotADirectoryError(self.root)
        found = [Folder(top, "")]
        for folder in found if self.recursive else ():
            for entry in store.get_file_info(fs.FileSelector(folder.path)):
                if entry.type == fs.FileType.Directory and entry.base_name not in OWNED:
                    found.append(Folder(entry.path, f"{folder.prefix}{entry.base_name}/"))
        return found

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        store, _ = _opened(self.root)
        for entry in sorted(store.get_file_info(fs.FileSelector(partition.path)), key=lambda e: e.base_name):
            if entry.type == fs.FileType.Directory or not _is_image(entry.base_name):
                continue
            length, content, error = entry.size, None, None
            if not length:
                error = EMPTY
            elif self.content:
                try:
                    with store.open_input_stream(entry.path) as file:
                        content = file.read()
                except OSError:
                    error = UNREADABLE
            values = [partition.prefix + entry.base_name, entry.path, length, entry.mtime, content, error]
            # one file a batch, so that a worker holds one
            yield pa.record_batch([pa.array([v], kind) for v, kind in zip(values, _TYPES, strict=True)], _NAMES)


def _is_image(name: str) -> bool:
    return not name.startswith(".") and name.lower().endswith(EXTENSIONS)


def qualified(spark: SparkSession, root: str) -> str:
    """A folder's whole path with its scheme, as Spark resolves it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _read(spark: SparkSession, root: str, recursive: bool, content: bool) -> DataFrame:
    """Raises NotADirectoryError if root is no folder."""
    whole = qualified(spark, root)
    store, top = _opened(whole)
    if store.get_file_info(top).type != fs.FileType.Directory:
        raise NotADirectoryError(root)
    spark.dataSource.register(ImageFolders)
    return spark.read.format("image_folders").option("recursive", str(recursive)).option("content", str(content)).load(whole)


def discovered(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """image_key (path below root), path, length and modified of every processable image by path, files without content included; they
    are not opened. Raises NotADirectoryError if root is no folder."""
    return ordered(_read(spark, root, recursive, False).drop("content", "error"))


def contents(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """image_key, path, length, content, source_sha256 and source_size of the images below root that can be read."""
    read = _read(spark, root, recursive, True).where("error IS NULL").select("image_key", "path", "length", "content")
    return read.withColumn("source_sha256", F.sha2("content", 256)).withColumn("source_size", F.octet_length("content").cast("long"))


def checked(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """image_key, path, length, modified, source_sha256, source_size and error of every processable image below root: each is read once,
    and error tells why one can't be."""
    read = _read(spark, root, recursive, True)
    return read.select("image_key", "path", "length", "modified", F.sha2("content", 256).alias("source_sha256"), F.octet_length("content").cast("long").alias("source_size"), "error")
