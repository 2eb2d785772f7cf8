"""Files on the address a Spark session uses, opened from the tasks.

Spark's own readers and writers know every address its Hadoop settings know. Where a task must write or read bytes
itself, ``Store`` opens the same address from Python: local paths, mounts and object stores directly, all others
(``hdfs``, ``viewfs`` and whatever a cluster configures) through Hadoop's client library. It is made on the driver,
takes the session's ``fs.`` settings along, and is sent to the tasks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import unquote, urlsplit

import pyarrow.fs as pafs
from pyspark.sql import SparkSession

Opener = Callable[[str, dict[str, str]], tuple[pafs.FileSystem, str]]
#: Openers of further schemes, (address, settings) -> (file system, path); one is sent along with its stores.
OPENERS: dict[str, Opener] = {}


def _s3(address: str, settings: dict[str, str]) -> tuple[pafs.FileSystem, str]:
    parts = urlsplit(address)

    def setting(name: str) -> str | None:
        return settings.get(f"fs.s3a.bucket.{parts.netloc}.{name}") or settings.get(f"fs.s3a.{name}")

    given = {
        "access_key": setting("access.key"),
        "secret_key": setting("secret.key"),
        "session_token": setting("session.token"),
        "region": setting("endpoint.region"),
        "endpoint_override": setting("endpoint"),
    }
    if setting("path.style.access") == "false":
        given["force_virtual_addressing"] = True
    return pafs.S3FileSystem(**{k: v for k, v in given.items() if v}), parts.netloc + parts.path


def _gs(address: str, settings: dict[str, str]) -> tuple[pafs.FileSystem, str]:
    parts = urlsplit(address)
    return pafs.GcsFileSystem(), parts.netloc + parts.path


def _azure(address: str, settings: dict[str, str]) -> tuple[pafs.FileSystem, str]:
    parts = urlsplit(address)
    container, _, host = parts.netloc.partition("@")
    key = settings.get(f"fs.azure.account.key.{host}")
    return pafs.AzureFileSystem(host.split(".")[0], **({"account_key": key} if key else {})), container + parts.path


def _mounted(address: str, settings: dict[str, str]) -> tuple[pafs.FileSystem, str]:
    return pafs.LocalFileSystem(), "/dbfs/" + urlsplit(address).path.lstrip("/")


def _local(address: str, settings: dict[str, str]) -> tuple[pafs.FileSystem, str]:
    return pafs.LocalFileSystem(), unquote(urlsplit(address).path) if address.startswith("file:") else address


def _hadoop(address: str, settings: dict[str, str]) -> tuple[pafs.FileSystem, str]:
    parts = urlsplit(address)
    return pafs.HadoopFileSystem(f"{parts.scheme}://{parts.hostname or 'default'}", parts.port or 0, extra_conf=settings), parts.path


SCHEMES = {"": _local, "file": _local, "s3": _s3, "s3a": _s3, "s3n": _s3, "gs": _gs, "abfs": _azure, "abfss": _azure, "wasbs": _azure, "dbfs": _mounted}


def scheme(address: str) -> str:
    return urlsplit(address).scheme if ":" in address.split("/")[0] else ""


@dataclass(frozen=True)
class Store:
    """A folder below which tasks read and write."""

    address: str
    settings: dict[str, str] = field(default_factory=dict, compare=False, repr=False)
    opener: Opener | None = field(default=None, compare=False)

    def opened(self) -> tuple[pafs.FileSystem, str]:
        """The file system, and the folder's path in it."""
        system, path = (self.opener or SCHEMES.get(scheme(self.address), _hadoop))(self.address, self.settings)
        return system, path.rstrip("/")


def store(spark: SparkSession, address: str) -> Store:
    """The store at ``address`` under the session's settings of file systems."""
    settings = {k.removeprefix("spark.hadoop."): v for k, v in spark.sparkContext.getConf().getAll() if k.startswith("spark.hadoop.fs.")}
    return Store(address, settings, OPENERS.get(scheme(address)))
