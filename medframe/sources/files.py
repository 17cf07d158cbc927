"""Files on any scheme, opened by the executors with the reader's own options.

A URI is opened through a ``pyarrow.fs`` file system made from its scheme, its
authority and the Hadoop-style options of the reader (``fs.s3a.access.key`` ...,
also per bucket). A worker keeps one file system per authority and options. Other
schemes can be served by a factory named in the option
``fs.<scheme>.factory = module:function``, called with (authority, options) and
returning a ``pyarrow.fs.FileSystem`` and the base path in it.
"""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyarrow import fs as pafs

# Options that say how to reach a file system; the rest are the scan's own.
PREFIXES = ("fs.", "dfs.")


def conf_of(options: dict | None) -> tuple:
    """The file-system options among ``options``, as a hashable value."""
    return tuple(sorted((str(k), str(v)) for k, v in (options or {}).items() if str(k).lower().startswith(PREFIXES)))


def split_uri(uri: str) -> tuple[str, str, str]:
    """(scheme, authority, path); a path without a scheme is local."""
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme or not scheme:
        return "file", "", uri
    if rest.startswith("//"):
        authority, slash, path = rest[2:].partition("/")
        return scheme.lower(), authority, slash + path
    return scheme.lower(), "", rest


class _Conf:
    """Options by key without regard to case; ``fs.s3a.bucket.B.key`` before ``fs.s3a.key``."""

    def __init__(self, conf: tuple):
        self.values = {k.lower(): v for k, v in conf}

    def get(self, key: str, default: str | None = None) -> str | None:
        return self.values.get(key.lower(), default)

    def s3(self, bucket: str, key: str) -> str | None:
        return self.get(f"fs.s3a.bucket.{bucket}.{key}", self.get(f"fs.s3a.{key}"))


def _s3(authority: str, conf: _Conf):
    named = {"access_key": "access.key", "secret_key": "secret.key", "session_token": "session.token",
             "endpoint_override": "endpoint", "region": "endpoint.region"}
    args: dict = {a: conf.s3(authority, k) for a, k in named.items() if conf.s3(authority, k)}
    endpoint = args.get("endpoint_override", "")
    if "://" in endpoint:
        args["scheme"], args["endpoint_override"] = endpoint.split("://", 1)
    elif (conf.s3(authority, "connection.ssl.enabled") or "true").lower() == "false":
        args["scheme"] = "http"
    if "Anonymous" in (conf.s3(authority, "aws.credentials.provider") or ""):
        args["anonymous"] = True
    if (conf.s3(authority, "path.style.access") or "").lower() == "false":
        args["force_virtual_addressing"] = True
    return pafs.S3FileSystem(**args), authority


def _gs(authority: str, conf: _Conf):
    if (conf.get("fs.gs.auth.type") or "").upper() == "UNAUTHENTICATED":
        return pafs.GcsFileSystem(anonymous=True), authority
    return pafs.GcsFileSystem(), authority


def _abfs(authority: str, conf: _Conf):
    container, _, host = authority.partition("@")
    args = {"account_name": host.partition(".")[0]}
    if key := conf.get(f"fs.azure.account.key.{host}"):
        args["account_key"] = key
    if token := conf.get(f"fs.azure.sas.fixed.token.{host}"):
        args["sas_token"] = token
    return pafs.AzureFileSystem(**args), container


def _hdfs(authority: str, conf: _Conf):
    return pafs.FileSystem.from_uri(f"hdfs://{authority}/")[0], ""


def _local(authority: str, conf: _Conf):
    return pafs.LocalFileSystem(), ""


FACTORIES: dict[str, Callable] = {
    "file": _local, "s3": _s3, "s3a": _s3, "s3n": _s3, "gs": _gs, "abfs": _abfs, "abfss": _abfs,
    "hdfs": _hdfs,
}


def _factory(scheme: str, conf: _Conf) -> Callable | None:
    named = conf.get(f"fs.{scheme}.factory")
    if not named:
        return FACTORIES.get(scheme)
    module, _, function = named.partition(":")
    return lambda authority, c: getattr(importlib.import_module(module), function)(authority, dict(c.values))


def supported(uri: str, options: dict | None = None) -> bool:
    """Whether executors can open files of this scheme themselves."""
    return _factory(split_uri(uri)[0], _Conf(conf_of(options))) is not None


@functools.lru_cache(maxsize=64)
def _system(scheme: str, authority: str, conf: tuple):
    """One file system per worker, authority and options."""
    options = _Conf(conf)
    factory = _factory(scheme, options)
    if factory is None:
        raise ValueError(f"no file system for {scheme!r}: name one in the option fs.{scheme}.factory "
                         "or read whole files with header_only=False")
    return factory(authority, options)


def locate(uri: str, conf: tuple = ()) -> tuple[pafs.FileSystem, str]:
    """(file system, path in it) of a URI."""
    scheme, authority, path = split_uri(uri)
    system, base = _system(scheme, authority, conf)
    # listed paths are not percent-encoded: taken as they are
    return system, f"{base.rstrip('/')}/{path.lstrip('/')}" if base or scheme == "file" else path


@dataclass(frozen=True)
class Found:
    path: str
    length: int
    modified: float     # seconds since the epoch
    values: tuple = ()  # partition values as text, None for the default partition


def entries(uri: str, conf: tuple = ()) -> Iterator[tuple[str, pafs.FileInfo]]:
    """(URI, info) of what lies directly in the folder ``uri``; nothing if it is none."""
    system, path = locate(uri, conf)
    for info in system.get_file_info(pafs.FileSelector(path, recursive=False, allow_not_found=True)):
        yield f"{uri.rstrip('/')}/{info.base_name}", info


def info(uri: str, conf: tuple = ()) -> pafs.FileInfo:
    system, path = locate(uri, conf)
    return system.get_file_info(path)


def read_range(uri: str, start: int, length: int | None, conf: tuple = ()) -> bytes:
    """``length`` bytes from ``start`` (None: to the end), nothing else of the file."""
    system, path = locate(uri, conf)
    with system.open_input_file(path) as f:
        if length is None:
            length = f.size() - start
        return f.read_at(length, start)


def size(uri: str, conf: tuple = ()) -> int:
    system, path = locate(uri, conf)
    with system.open_input_file(path) as f:
        return f.size()
