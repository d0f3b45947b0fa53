"""Catalog connections: connection strings to structured specifications, and DB-API connections from those."""

from __future__ import annotations

import re
import shlex
import sys
import threading
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from typing import Any
from urllib.parse import unquote, urlsplit

#: The prefix of native connection strings. Fixed value of the format.
NATIVE_PREFIX = "ducklake:"


@dataclass(frozen=True)
class CatalogSpec:
    """A metadata database: its kind, a file for embedded ones, named parameters for servers."""

    kind: str  # sqlite, duckdb, postgres, mysql
    path: str = ""
    params: tuple[tuple[str, str], ...] = field(default=())
    owned = True

    def of(self, connection: Any) -> CatalogSpec:
        return self

    @property
    def quote(self) -> str:
        return "`" if self.kind == "mysql" else '"'

    @property
    def mark(self) -> str:
        """How a bound value is written in SQL."""
        return "?" if self.kind in ("sqlite", "duckdb") else "%s"

    def connect(self) -> Any:
        p = dict(self.params)
        if self.kind == "sqlite":
            import sqlite3

            return sqlite3.connect(f"file:{self.path}?mode=ro" if self.path != ":memory:" else self.path, uri=self.path != ":memory:")
        if self.kind == "duckdb":
            import duckdb

            return duckdb.connect(self.path, read_only=True)
        if self.kind == "postgres":
            try:
                import psycopg
            except ImportError as e:
                raise ImportError("a PostgreSQL catalog needs the psycopg package") from e
            return psycopg.connect(**p)
        try:
            import pymysql
        except ImportError as e:
            raise ImportError("a MySQL catalog needs the pymysql package") from e
        return pymysql.connect(**({k: v for k, v in p.items() if k != "port"} | ({"port": int(p["port"])} if "port" in p else {})))


def _pairs(body: str, kind: str) -> dict[str, str]:
    if not body.strip():
        raise ValueError(f"a {kind} catalog needs key=value parameters")
    found = {}
    for word in shlex.split(body):
        key, eq, value = word.partition("=")
        if not eq:
            raise ValueError(f"malformed {kind} parameter {word!r}: key=value is expected")
        found[key.strip().lower()] = value
    return found


def _server(kind: str, pairs: dict[str, str]) -> CatalogSpec:
    names = ("dbname", "database") if kind == "postgres" else ("database", "db", "dbname")
    database = next((pairs[n] for n in names if pairs.get(n)), None)
    if not database:
        raise ValueError(f"a {kind} catalog needs a {names[0]!r} parameter")
    kept = {"dbname" if kind == "postgres" else "database": database, "host": pairs.get("host") or "localhost"}
    kept |= {k: pairs[k] for k in ("user", "password", "port") if pairs.get(k)}
    return CatalogSpec(kind, params=tuple(sorted(kept.items())))


def parse(text: str) -> CatalogSpec:
    """A native string (``ducklake:...``) or a URL (``sqlite:///``, ``duckdb:///``, ``postgresql://``, ``mysql://``)."""
    if text.startswith(NATIVE_PREFIX):
        body = text[len(NATIVE_PREFIX) :]
        kind, colon, rest = body.partition(":")
        if colon and kind in ("sqlite", "duckdb"):
            if not rest:
                raise ValueError(f"{NATIVE_PREFIX}{kind}: needs a database path")
            return CatalogSpec(kind, rest)
        if colon and kind in ("postgres", "mysql"):
            return _server(kind, _pairs(rest, kind))
        if colon and kind == "postgresql":
            raise ValueError(f"{kind!r} is written {NATIVE_PREFIX}postgres:...")
        if not body:
            raise ValueError(f"{NATIVE_PREFIX} needs a path or a backend after it")
        return CatalogSpec("duckdb", body)
    m = re.fullmatch(r"(sqlite|duckdb)(?:\+\w+)?:///(.+)", text)
    if m:
        return CatalogSpec(m[1], m[2])
    url = urlsplit(text)
    kind = {"postgresql": "postgres", "postgres": "postgres", "mysql": "mysql"}.get(url.scheme.split("+")[0])
    if kind is None:
        raise ValueError(f"not a catalog connection string: {text!r}")
    found = {"database": url.path.lstrip("/"), "host": url.hostname or "", "user": unquote(url.username or ""), "password": unquote(url.password or "")}
    return _server(kind, found | ({"port": str(url.port)} if url.port else {}))


_specs: dict[str, CatalogSpec] = {}
_lock = threading.Lock()


#: Kinds of database by the first name of a driver's module.
_DRIVERS = {"sqlite3": "sqlite", "duckdb": "duckdb", "_duckdb": "duckdb", "psycopg": "postgres", "psycopg2": "postgres", "pg8000": "postgres", "pymysql": "mysql", "MySQLdb": "mysql", "mysql": "mysql"}
_MARKS = {"qmark": "?", "format": "%s", "pyformat": "%s"}


@dataclass(frozen=True)
class Factory:
    """A caller's own way to connect; bypasses the parsing of strings.

    What is not given is told by the connection: its driver's kind, and how that driver marks bound values.
    owned: whether connections are closed after use.
    """

    connect: Callable[[], Any]
    kind: str = ""
    quote: str = ""
    mark: str = ""
    owned: bool = True

    def of(self, connection: Any) -> Factory:
        """With the kind, quote and mark that the connection's driver has."""
        module = sys.modules.get(type(connection).__module__.partition(".")[0])
        kind = self.kind or _DRIVERS.get(type(connection).__module__.partition(".")[0], "")
        if not kind:
            raise ValueError(f"connections of {type(connection).__module__!r} are not known: give Factory(connect, kind=...)")
        mark = self.mark or ("?" if kind in ("sqlite", "duckdb") else _MARKS.get(getattr(module, "paramstyle", ""), "%s"))
        return replace(self, kind=kind, mark=mark, quote=self.quote or ("`" if kind == "mysql" else '"'))


def resolve(catalog: Any) -> CatalogSpec | Factory:
    """A string, a specification, a `Factory`, a function that returns a DB-API connection, or such a connection (left open)."""
    if isinstance(catalog, CatalogSpec | Factory):
        return catalog
    if isinstance(catalog, str):
        with _lock:
            if catalog not in _specs:
                _specs[catalog] = parse(catalog)
            return _specs[catalog]
    if hasattr(catalog, "cursor"):
        return Factory(lambda: catalog, owned=False)
    if callable(catalog):
        return Factory(catalog)
    raise TypeError(f"a catalog is a connection string or a connection factory, not {type(catalog).__name__}")
