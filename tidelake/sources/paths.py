"""Where files lie: lake, schema, table and file segments composed to one path."""

from __future__ import annotations

import re

_ABSOLUTE = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*:|/)")


def is_absolute(path: str) -> bool:
    return bool(_ABSOLUTE.match(path))


def join(base: str, segment: str) -> str:
    """Append with exactly one slash; an empty side leaves the other."""
    if not base or not segment:
        return base or segment
    return f"{base.rstrip('/')}/{segment.lstrip('/')}"


def resolve(file: tuple[str, bool], table: tuple[str | None, bool], schema: tuple[str | None, bool], data_path: str | None) -> str:
    """Full path of a file; each argument but the last is (path, is relative to what is above it)."""
    path, relative = file
    if not relative:
        return path
    base = data_path or ""
    for segment, below in (schema, table):
        if segment:
            base = join(base, segment) if below else segment
    if not base:
        raise ValueError(f"relative path {path!r} without a base: the catalog has no data_path")
    return join(base, path)


#: URI schemes by what Hadoop calls them. Fixed values.
_HADOOP_SCHEMES = {"s3": "s3a", "s3n": "s3a", "gcs": "gs", "az": "abfs", "azure": "abfs"}

#: Object-store options by Hadoop settings. Fixed values.
_HADOOP_OPTIONS = {
    "aws_access_key_id": "fs.s3a.access.key",
    "aws_secret_access_key": "fs.s3a.secret.key",
    "aws_session_token": "fs.s3a.session.token",
    "aws_endpoint_url": "fs.s3a.endpoint",
    "aws_endpoint": "fs.s3a.endpoint",
    "aws_region": "fs.s3a.endpoint.region",
}


def hadoop(path: str, account: str | None = None) -> str:
    """The path as Hadoop writes it; a container of an object store that has accounts gets its account, where one is given."""
    scheme, sep, rest = path.partition("://")
    if not sep:
        return path
    name = _HADOOP_SCHEMES.get(scheme, scheme)
    container, slash, inside = rest.partition("/")
    if name in ("abfs", "abfss") and account and "@" not in container:
        rest = f"{container}@{account}.dfs.core.windows.net{slash}{inside}"
    return f"{name}://{rest}"


def account(storage: dict[str, str] | None) -> str | None:
    """The storage account that options name."""
    low = {k.lower(): v for k, v in (storage or {}).items()}
    return next((str(low[k]) for k in ("azure_storage_account_name", "account_name") if low.get(k)), None)


def reader_options(storage: dict[str, str] | None) -> dict[str, str]:
    """Options for Spark's readers; names that are not known pass as they are."""
    out = {}
    for key, value in (storage or {}).items():
        low = key.lower()
        if low == "aws_allow_http":
            out["fs.s3a.connection.ssl.enabled"] = "false" if str(value).lower() in ("true", "1") else "true"
        elif low == "aws_virtual_hosted_style_request":
            out["fs.s3a.path.style.access"] = "false" if str(value).lower() in ("true", "1") else "true"
        else:
            out[_HADOOP_OPTIONS.get(low, key)] = str(value)
    return out
