import pytest

from tidelog.sources import config

BASE = {"CDC_SOURCE_PGDATABASE": "a", "CDC_SOURCE_PGUSER": "b"}
DEST = {"CDC_SINK": "postgres", "CDC_DEST_PGDATABASE": "c", "CDC_DEST_PGUSER": "d"}


def test_defaults():
    c = config.load(BASE)
    assert (c.sink, c.apply_mode, c.schema_evolution, c.status_interval, c.retry_most, c.retry_attempts, c.source.port) == ("file", "explicit", "disabled", 10, 30, 0, 5432)
    assert c.tables == ("public.clientes", "public.enderecos") and c.destination is None and "secret" not in repr(config.load(BASE | {"CDC_SOURCE_PGPASSWORD": "secret"}))


@pytest.mark.parametrize(
    "more",
    [{"CDC_SINK": "kafka"}, {"CDC_SINK": "postgres"}, DEST | {"CDC_SCHEMA_EVOLUTION": "auto"}, DEST | {"CDC_POSTGRES_APPLY_MODE": "generic", "CDC_TABLE_INCLUDE": ""}, {"CDC_TABLE_INCLUDE": "clientes"}, {"CDC_RETRY_INITIAL_DELAY": "40s"}, {"CDC_RETRY_MAX_ATTEMPTS": "-1"}, {"CDC_STATUS_INTERVAL": "0s"}, {"CDC_HEALTH_ENABLED": "maybe"}, {"CDC_SOURCE_PGUSER": ""}],
)
def test_refused(more):
    with pytest.raises(ValueError):
        config.load(BASE | more)


def test_accepted():
    c = config.load(BASE | DEST | {"CDC_SCHEMA_EVOLUTION": "auto", "CDC_POSTGRES_APPLY_MODE": "generic", "CDC_STATUS_INTERVAL": "500ms", "CDC_SCHEMA_AUDIT_LOG": "true"})
    assert c.schema_evolution == "auto" and c.status_interval == 0.5 and c.audit


def test_slots():
    assert [config.slot_problem(*x) for x in ((None, False), ("wal2json", False), ("pgoutput", True), ("pgoutput", False))] == ["slot not found", "slot uses wal2json, not pgoutput", "slot is in use", None]


def test_dotenv(tmp_path):
    at = tmp_path / ".env"
    at.write_text("# settings\nCDC_SOURCE_PGDATABASE=a\nexport CDC_SOURCE_PGUSER='b c'\n\nCDC_SLOT=from_file\n")
    assert (config.load({}, str(at)).source.user, config.load({"CDC_SLOT": "real"}, str(at)).slot, config.load({}, str(at)).slot) == ("b c", "real", "from_file")
    assert config.dotenv(str(tmp_path / "none")) == {}
