"""Settings from the environment: defaults, types, and the rules between them."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

from ..operators.filters import parse_tables

# Names and defaults that existing deployments use.
DEFAULT_TABLES = "public.clientes,public.enderecos"
_UNITS = {"ms": 0.001, "s": 1.0, "m": 60.0, "h": 3600.0}


def seconds(text: str) -> float:
    """A positive duration such as 500ms, 10s, 2m or 1h."""
    for unit in ("ms", "s", "m", "h"):
        if text.endswith(unit):
            value = float(text[: -len(unit)]) * _UNITS[unit]
            if value > 0:
                return value
    raise ValueError(f"not a positive duration: {text!r}")


def truth(text: str) -> bool:
    if text in ("1", "t", "T", "true", "TRUE", "True"):
        return True
    if text in ("0", "f", "F", "false", "FALSE", "False"):
        return False
    raise ValueError(f"not a truth value: {text!r}")


@dataclass(frozen=True)
class Connection:
    host: str = "localhost"
    port: int = 5432
    database: str = ""
    user: str = ""
    password: str = field(default="", repr=False)
    sslmode: str = "disable"

    def __post_init__(self) -> None:
        if not self.host or not 0 < self.port < 65536 or not self.database or not self.user:
            raise ValueError("a connection needs host, port, database and user")


@dataclass(frozen=True)
class Config:
    source: Connection
    destination: Connection | None
    source_id: str = "cdc-demo"
    slot: str = "cdc_slot"
    publication: str = "cdc_publication"
    sink: str = "file"
    output: str = "cdc.txt"
    apply_mode: str = "explicit"
    schema_evolution: str = "disabled"
    tables: tuple[str, ...] = tuple(parse_tables(DEFAULT_TABLES))
    autoconfigure: bool = False
    audit: bool = False
    status_interval: float = 10.0
    retry_initial: float = 1.0
    retry_most: float = 30.0
    retry_attempts: int = 0
    health: bool = True
    health_address: str = ":8080"
    pause_before_ack: bool = False
    pause_after_commit: bool = False
    pause_match: str = ""
    fail_write_match: str = ""

    def __post_init__(self) -> None:
        for name, value in (("source_id", self.source_id), ("slot", self.slot), ("publication", self.publication)):
            if not value:
                raise ValueError(f"{name} is empty")
        for name, value, known in (("sink", self.sink, ("file", "postgres")), ("apply_mode", self.apply_mode, ("explicit", "generic")), ("schema_evolution", self.schema_evolution, ("disabled", "manual", "auto"))):
            if value not in known:
                raise ValueError(f"{name} must be one of {', '.join(known)}, not {value!r}")
        if self.sink == "file" and not self.output:
            raise ValueError("the file sink needs an output")
        if self.sink == "postgres" and self.destination is None:
            raise ValueError("the postgres sink needs a destination")
        if self.schema_evolution == "auto" and self.apply_mode != "generic":
            raise ValueError("schema_evolution auto needs apply_mode generic")
        if (self.apply_mode == "generic" or self.autoconfigure) and not self.tables:
            raise ValueError("a table list is needed")
        if self.retry_attempts < 0 or self.retry_most < self.retry_initial:
            raise ValueError("retry settings are out of order")


def _connection(env: Mapping[str, str], prefix: str) -> Connection:
    get = lambda k, d="": env.get(f"{prefix}{k}", d)
    return Connection(get("HOST", "localhost"), int(get("PORT", "5432")), get("DATABASE"), get("USER"), get("PASSWORD"), get("SSLMODE", "disable"))


def dotenv(path: str = ".env") -> dict[str, str]:
    """Settings of a file of KEY=value lines; blank lines and # comments are skipped, quotes around a value go. Optional."""
    out: dict[str, str] = {}
    if not os.path.isfile(path):
        return out
    with open(path, encoding="utf-8") as f:
        for line in f:
            name, sep, value = line.strip().removeprefix("export ").partition("=")
            if sep and name and not name.startswith("#"):
                value = value.strip()
                out[name.strip()] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"" else value
    return out


def load(env: Mapping[str, str] | None = None, file: str | None = None) -> Config:
    """The settings of an environment (the process's by default) over those of a file; ValueError where they don't fit."""
    env = (dotenv(file) if file else {}) | dict(os.environ if env is None else env)
    get = lambda k, d: env.get(f"CDC_{k}") or d
    sink = get("SINK", "file")
    return Config(
        source=_connection(env, "CDC_SOURCE_PG"), destination=_connection(env, "CDC_DEST_PG") if sink == "postgres" else None, source_id=get("SOURCE_ID", "cdc-demo"), slot=get("SLOT", "cdc_slot"), publication=get("PUBLICATION", "cdc_publication"), sink=sink, output=get("OUTPUT_FILE", "cdc.txt"),
        apply_mode=get("POSTGRES_APPLY_MODE", "explicit"), schema_evolution=get("SCHEMA_EVOLUTION", "disabled"), tables=tuple(parse_tables(env.get("CDC_TABLE_INCLUDE", DEFAULT_TABLES))), autoconfigure=truth(get("PUBLICATION_AUTOCONFIGURE", "false")), audit=truth(get("SCHEMA_AUDIT_LOG", "false")),
        status_interval=seconds(get("STATUS_INTERVAL", "10s")), retry_initial=seconds(get("RETRY_INITIAL_DELAY", "1s")), retry_most=seconds(get("RETRY_MAX_DELAY", "30s")), retry_attempts=int(get("RETRY_MAX_ATTEMPTS", "0")), health=truth(get("HEALTH_ENABLED", "true")), health_address=get("HEALTH_ADDR", ":8080"),
        pause_before_ack=truth(get("TEST_PAUSE_BEFORE_ACK", "false")), pause_after_commit=truth(get("TEST_PAUSE_AFTER_SINK_COMMIT", "false")), pause_match=get("TEST_PAUSE_MATCH", ""), fail_write_match=get("TEST_FAIL_WRITE_MATCH", ""),
    )


def slot_problem(plugin: str | None, active: bool) -> str | None:
    """Why a replication slot can't be read; None if it can. plugin None: there is no such slot."""
    if plugin is None:
        return "slot not found"
    if plugin != "pgoutput":
        return f"slot uses {plugin}, not pgoutput"
    return "slot is in use" if active else None
