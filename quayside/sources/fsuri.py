"""Executor-side file-system resolution for ``pyarrow.fs`` from Hadoop-style URIs.

Only the scheme and authority go through URI parsing; the rest of the path is
kept verbatim, so names with ``#``, ``?``, ``%`` or spaces (which Spark lists
raw) are opened as they are. Hadoop's ``s3a``/``s3n`` schemes map to ``s3``.

Spark opens storage with the session's Hadoop settings; ``storage_settings``
reads those for S3 and Azure on the driver, and ``FileSystems(settings)`` applies
them in the tasks (endpoint, region, keys, path style, per-bucket overrides). Azure
URIs are taken apart here: the user part is the container, the first label of the
host the account, the rest of the host the service's domain.
"""

from __future__ import annotations

import re
import sys

from pyspark import cloudpickle

# Task code that uses this module is shipped by value; so is this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SCHEME_ALIASES = {"s3a": "s3", "s3n": "s3"}
_SETTINGS = ("fs.s3a.", "fs.azure.")
_AZURE = ("abfs", "abfss", "wasb", "wasbs")
_AZURE_DOMAIN = "core.windows.net"


def has_scheme(uri: str) -> bool:
    return re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", uri) is not None


def split_uri(uri: str) -> tuple[str | None, str]:
    """``(file-system root URI or None for local, path or key)``. A scheme without an
    authority (``hdfs:/x``) names no file system by itself and is refused."""
    if uri.startswith("file:") or not has_scheme(uri):
        path = uri[len("file:"):] if uri.startswith("file:") else uri
        while path.startswith("//"):
            path = path[1:]
        return None, path
    scheme, rest = uri.split(":", 1)
    authority, _, key = rest[2:].partition("/")
    if not rest.startswith("//") or not authority:
        raise ValueError(f"no authority in {uri!r}; qualify it against a file system first")
    return f"{_SCHEME_ALIASES.get(scheme, scheme)}://{authority}/", key


def storage_settings(spark) -> dict[str, str]:
    """The session's Hadoop settings for S3 and Azure (driver side, once)."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return {p + e.getKey(): e.getValue() for p in _SETTINGS for e in conf.getPropsWithPrefix(p).entrySet()}


def s3_options(settings: dict[str, str], bucket: str) -> dict:
    """Arguments of ``pyarrow.fs.S3FileSystem`` from ``fs.s3a.*``; a bucket's own settings come first."""

    def get(name: str, default: str | None = None) -> str | None:
        return settings.get(f"fs.s3a.bucket.{bucket}.{name}") or settings.get(f"fs.s3a.{name}") or default

    out: dict = {}
    for ours, theirs in (("access_key", "access.key"), ("secret_key", "secret.key"), ("session_token", "session.token"), ("region", "endpoint.region")):
        if get(theirs):
            out[ours] = get(theirs)
    endpoint = get("endpoint")
    if endpoint and not re.fullmatch(r"(https?://)?s3[.-]?([a-z0-9-]+\.)?amazonaws\.com", endpoint):
        if "://" in endpoint:
            out["scheme"], endpoint = endpoint.split("://", 1)
        elif get("connection.ssl.enabled", "true") == "false":
            out["scheme"] = "http"
        out["endpoint_override"] = endpoint.rstrip("/")
        out["force_virtual_addressing"] = get("path.style.access", "false") != "true"
    return out


def azure_options(settings: dict[str, str], root: str) -> tuple[str, dict]:
    """``(container, arguments of pyarrow.fs.AzureFileSystem)`` for ``scheme://container@host/``."""
    container, at, host = root.split("://", 1)[1].rstrip("/").partition("@")
    if not at or not container or not host:
        raise ValueError(f"expected container@account in {root!r}")
    account, _, domain = host.partition(".")
    out = {"account_name": account}
    if domain and not domain.endswith(_AZURE_DOMAIN):
        out["dfs_storage_authority"] = f".{domain}"
        out["blob_storage_authority"] = "." + re.sub(r"^dfs\.", "blob.", domain)
    return container, out | _azure_login(settings, host)


def _azure_login(settings: dict[str, str], host: str) -> dict:
    """The login that ``fs.azure.account.auth.type`` names: an account key, OAuth by client credentials or managed identity, or
    a fixed SAS token. Refuses what pyarrow cannot do, rather than try another login than Spark's."""

    def get(name: str) -> str | None:
        return settings.get(f"{name}.{host}") or settings.get(name)

    kind, key = (get("fs.azure.account.auth.type") or "SharedKey").lower(), get("fs.azure.account.key")
    if kind == "sharedkey":
        return {"account_key": key} if key else {}
    if kind == "sas" and get("fs.azure.sas.fixed.token"):
        return {"sas_token": get("fs.azure.sas.fixed.token").lstrip("?")}
    if kind == "oauth":
        provider = (get("fs.azure.account.oauth.provider.type") or "").rpartition(".")[2]
        client, secret = get("fs.azure.account.oauth2.client.id"), get("fs.azure.account.oauth2.client.secret")
        tenant = re.search(r"//[^/]+/([^/]+)/oauth2", get("fs.azure.account.oauth2.client.endpoint") or "")
        if provider == "ClientCredsTokenProvider" and client and secret and tenant:
            return {"tenant_id": tenant[1], "client_id": client, "client_secret": secret}
        if provider == "MsiTokenProvider":
            return {"client_id": client} if client else {}
        raise ValueError(f"cannot log in to {host!r} by OAuth provider {provider!r} with these fs.azure.account.oauth2 settings")
    raise ValueError(f"cannot log in to {host!r} with fs.azure.account.auth.type {get('fs.azure.account.auth.type')!r}")


class FileSystems:
    """Per-task cache of pyarrow file systems, one per scheme and authority."""

    def __init__(self, settings: dict[str, str] | None = None):
        self._settings, self._cache = settings or {}, {}

    def _open(self, root: str):
        import pyarrow.fs as pafs

        scheme, authority = root.rstrip("/").split("://", 1)
        if scheme == "s3":
            options = s3_options(self._settings, authority)
            return (pafs.S3FileSystem(**options), authority) if options else pafs.FileSystem.from_uri(root)
        if scheme in _AZURE:
            container, options = azure_options(self._settings, root)
            return pafs.AzureFileSystem(**options), container
        return pafs.FileSystem.from_uri(root)

    def resolve(self, uri: str):
        import pyarrow.fs as pafs

        root, key = split_uri(uri)
        if root is None:
            if "local" not in self._cache:
                self._cache["local"] = pafs.LocalFileSystem()
            return self._cache["local"], key
        if root not in self._cache:
            self._cache[root] = self._open(root)
        fs, base = self._cache[root]
        base = base.rstrip("/")
        if not key:
            return fs, base or "/"
        return fs, f"{base}/{key}" if base else f"/{key}"
