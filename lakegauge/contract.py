"""Dataset contracts: the YAML format, its validation and its lint."""

from __future__ import annotations

import os
import re
import zlib
from dataclasses import asdict, dataclass, field
from typing import Any

# The contract file format.
LOGICAL_TYPES = ("boolean", "datetime", "decimal", "float", "integer", "string")
PARTITION_KINDS = ("harian", "mingguan", "snapshot", "tanpa_partisi")
GRAINS = ("hari", "jam", "minggu")
EPOCH_UNITS = ("detik", "milidetik", "mikrodetik", "nanodetik")
DATASET_KEYS = ("deskripsi", "sumber", "ukuran_berkas", "meta_audit", "kunci", "kolom", "relasi", "sama_nilai",
                "urutan_waktu", "flag_dq", "ambang", "sla_lag_hari", "distribusi", "validasi")
COLUMN_KEYS = ("nama", "tipe", "wajib", "rentang", "satuan", "pola", "panjang", "nilai_sah", "referensi",
               "profil_distribusi", "regex", "relasi", "sumber", "flag_dq", "deskripsi")
SOURCE_KEYS = ("lokal", "s3", "partisi", "nama_berkas", "sql_server")
KEY_KEYS = ("surrogate", "bisnis", "waktu", "satuan_waktu", "waktu_muat", "granularitas")
# Threshold defaults.
THRESHOLDS = {"toleransi_volume": 0.15, "batas_kl": 1.0, "batas_zscore": 20.0, "margin_null": 0.05,
              "margin_mean": 2.0, "margin_stdev": 2.0, "margin_kuantil_bawah": 0.5, "margin_kuantil_atas": 1.5}
LAG_DAYS = {"harian": 2.0, "backfill": 260.0}

_ENV = re.compile(r"\$\{([A-Za-z_]\w*)\}")


class ContractError(Exception):
    """A mistake in a contract file, worded for its editor."""


@dataclass
class ColumnContract:
    name: str
    kind: str = "string"
    required: bool = True
    bounds: tuple | None = None
    unit: str | None = None
    patterns: list[str] | None = None
    length: tuple | None = None
    allowed: list | None = None
    reference: bool = False
    profiled: bool = False
    formats: list[str] | None = None
    master: str | None = None           # "dataset.column" holding the official codes


@dataclass
class Contract:
    name: str
    columns: list[ColumnContract]
    description: str = ""
    local: str | None = None
    remote: str | None = None
    partitioning: str = "harian"
    source_table: str | None = None
    source_time: str | None = None
    source_offset_hours: float = 0.0
    size_bounds: tuple | None = None
    audit_columns: list[str] = field(default_factory=list)
    surrogate_key: str | None = None
    business_key: list[str] = field(default_factory=list)
    event_time: str | None = None
    epoch_unit: str | None = None
    load_time: str | None = None
    grain: str | None = None
    relations: list[tuple[str, str]] = field(default_factory=list)
    equal_pairs: list[tuple[str, str]] = field(default_factory=list)
    ordered_pairs: list[tuple[str, str]] = field(default_factory=list)
    flags: list[dict] = field(default_factory=list)
    thresholds: dict = field(default_factory=lambda: dict(THRESHOLDS))
    lag_days: dict = field(default_factory=lambda: dict(LAG_DAYS))
    # blocks the shipped contracts declare beside the core rules
    master_links: list[dict] = field(default_factory=list)      # column, table, master column
    null_limits: dict = field(default_factory=dict)             # column -> largest null share
    duplicate_limits: list[dict] = field(default_factory=list)  # columns, threshold
    predicates: list[dict] = field(default_factory=list)        # name, expression, null_passes
    expected_ratios: dict = field(default_factory=dict)         # boolean column -> share of true
    expected_values: dict = field(default_factory=dict)         # column -> allowed values
    ratio_tolerance: float = 0.1
    warnings: list[str] = field(default_factory=list)

    def fingerprint(self) -> int:
        """Changes with anything the contract says about its data."""
        return zlib.crc32(repr({k: v for k, v in asdict(self).items() if k not in ("warnings", "thresholds", "lag_days")}).encode())

    def column(self, name: str) -> ColumnContract | None:
        return next((c for c in self.columns if c.name == name), None)

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def text_columns(self) -> list[str]:
        return [c.name for c in self.columns if c.kind == "string"]

    @property
    def reference_columns(self) -> list[str]:
        return [c.name for c in self.columns if c.reference]

    @property
    def profiled_columns(self) -> list[ColumnContract]:
        return [c for c in self.columns if c.profiled]


def unresolved_variables(text: str | None) -> list[str]:
    """Names of ``${VAR}`` placeholders the environment did not fill."""
    return _ENV.findall(text or "")


def _expand(node: Any) -> Any:
    if isinstance(node, dict):
        return {k: _expand(v) for k, v in node.items()}
    if isinstance(node, list):
        return [_expand(v) for v in node]
    if isinstance(node, str):
        return _ENV.sub(lambda m: os.environ.get(m[1], m[0]), node)
    return node


def _listed(value) -> list:
    return [value] if isinstance(value, str) else list(value or [])


def _two(value, where: str, what: str) -> tuple | None:
    if value is None:
        return None
    if isinstance(value, (list, tuple)) and len(value) == 2:
        return tuple(value)
    raise ContractError(f"{where}: '{what}' must be [min, max], got {value!r}")


def _choice(value, allowed, where: str):
    if value is not None and value not in allowed:
        raise ContractError(f"{where}: {value!r} is not one of {list(allowed)}")
    return value


def _column(raw, where: str, warn: list[str]) -> ColumnContract:
    if isinstance(raw, str):
        return ColumnContract(raw)
    if not isinstance(raw, dict) or not raw.get("nama"):
        raise ContractError(f"{where}: every column needs 'nama', got {raw!r}")
    at = f"{where}.{raw['nama']}"
    warn += [f"{at}: unknown key '{k}'" for k in raw if k not in COLUMN_KEYS]
    return ColumnContract(
        name=raw["nama"],
        kind=_choice(raw.get("tipe", "string"), LOGICAL_TYPES, f"{at}.tipe"),
        required=bool(raw.get("wajib", True)),
        bounds=_two(raw.get("rentang"), at, "rentang"),
        unit=raw.get("satuan"),
        patterns=_listed(raw.get("pola")) or None,
        length=_two(raw.get("panjang"), at, "panjang"),
        allowed=raw.get("nilai_sah"),
        reference=bool(raw.get("referensi", False)),
        profiled=bool(raw.get("profil_distribusi", False)),
        formats=_listed(raw.get("regex")) or None,
        master=raw.get("relasi"),
    )


def _pairs(raw: dict, key: str, where: str) -> list[tuple[str, str]]:
    out = []
    for item in raw.get(key) or []:
        if not isinstance(item, (list, tuple)) or len(item) != 2:
            raise ContractError(f"{where}.{key}: expected a pair of columns, got {item!r}")
        out.append((str(item[0]), str(item[1])))
    return out


def parse_contract(name: str, raw: dict, default: dict | None = None) -> Contract:
    """One dataset block, merged with the ``default`` block and validated."""
    where, default = f"datasets.{name}", default or {}
    if not isinstance(raw, dict):
        raise ContractError(f"{where}: expected a block, got {type(raw).__name__}")
    warn = [f"{where}: unknown key '{k}'" for k in raw if k not in DATASET_KEYS]
    src, keys = raw.get("sumber") or {}, raw.get("kunci") or {}
    warn += [f"{where}.sumber: unknown key '{k}'" for k in src if k not in SOURCE_KEYS]
    warn += [f"{where}.kunci: unknown key '{k}'" for k in keys if k not in KEY_KEYS]
    sql = src.get("sql_server") or {}

    columns = [_column(c, where, warn) for c in raw.get("kolom") or []]
    if not columns:
        raise ContractError(f"{where}: 'kolom' must list at least one column")
    names = [c.name for c in columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ContractError(f"{where}: columns listed twice: {twice}")

    if keys.get("satuan_waktu") and not keys.get("waktu"):
        raise ContractError(f"{where}.kunci.satuan_waktu needs 'kunci.waktu'")
    if sql.get("kolom_waktu") and not sql.get("tabel"):
        raise ContractError(f"{where}.sumber.sql_server.kolom_waktu needs 'tabel'")
    size = _two((raw.get("ukuran_berkas") or {}).get("rentang"), where, "ukuran_berkas.rentang")
    if size and None in size:
        raise ContractError(f"{where}.ukuran_berkas.rentang needs both bounds")
    # an own 'meta_audit' replaces the default as a whole; an empty list opts out
    audit = (raw if "meta_audit" in raw else default).get("meta_audit") or {}

    checks = raw.get("validasi") or {}
    quality = checks.get("data_quality") or []
    c = Contract(
        name=name, columns=columns, description=raw.get("deskripsi", name),
        local=src.get("lokal"), remote=src.get("s3"),
        partitioning=_choice(src.get("partisi", "harian"), PARTITION_KINDS, f"{where}.sumber.partisi"),
        source_table=sql.get("tabel"), source_time=sql.get("kolom_waktu"),
        source_offset_hours=float(sql.get("offset_jam") or 0),
        size_bounds=tuple(map(float, size)) if size else None,
        audit_columns=list(audit.get("wajib") or []),
        surrogate_key=keys.get("surrogate"), business_key=list(keys.get("bisnis") or []),
        event_time=keys.get("waktu"), load_time=keys.get("waktu_muat"),
        epoch_unit=_choice(keys.get("satuan_waktu"), EPOCH_UNITS, f"{where}.kunci.satuan_waktu"),
        grain=_choice(keys.get("granularitas"), GRAINS, f"{where}.kunci.granularitas"),
        relations=_pairs(raw, "relasi", where), equal_pairs=_pairs(raw, "sama_nilai", where),
        ordered_pairs=_pairs(raw, "urutan_waktu", where), flags=list(raw.get("flag_dq") or []),
        thresholds={k: float((raw.get("ambang") or {}).get(k, (default.get("ambang") or {}).get(k, v)))
                    for k, v in THRESHOLDS.items()},
        lag_days={k: float(v) for k, v in {**(default.get("sla_lag_hari") or LAG_DAYS),
                                           **(raw.get("sla_lag_hari") or {})}.items()},
        master_links=[{"column": r["kolom"], "table": r["source_table"], "key": r["source_column"]}
                      for r in checks.get("referential_integrity") or []],
        null_limits={col: float(q["threshold"]) for q in quality if q.get("check") == "null_percentage"
                     for col in q.get("columns") or []},
        duplicate_limits=[{"columns": list(q["columns"]), "threshold": int(q.get("threshold", 0))}
                          for q in quality if q.get("check") == "duplicate_check"],
        predicates=[{"name": q.get("check", "predicate"), "expression": q["validation"],
                     "null_passes": bool(q.get("null_passes", False))}
                    for q in quality if q.get("validation")],
        expected_ratios={d["kolom"]: float(d["expected_ratio"]) for d in raw.get("distribusi") or []
                         if d.get("expected_ratio") is not None},
        expected_values={d["kolom"]: list(dict.fromkeys(d["expected_values"])) for d in raw.get("distribusi") or []
                         if d.get("expected_values")},
        warnings=warn,
    )
    for col in columns:
        if col.master and "." in col.master:
            table, key = col.master.rsplit(".", 1)
            c.master_links.append({"column": col.name, "table": table, "key": key})

    mentioned = {"kunci.surrogate": [c.surrogate_key], "kunci.waktu": [c.event_time],
                 "kunci.waktu_muat": [c.load_time], "kunci.bisnis": c.business_key,
                 "relasi": sum(c.relations, ()), "sama_nilai": sum(c.equal_pairs, ()),
                 "urutan_waktu": sum(c.ordered_pairs, ()),
                 "flag_dq": [f.get(k) for f in c.flags for k in ("flag", "kolom")]}
    for place, cols in mentioned.items():
        for col in cols:
            if col and col not in names:
                raise ContractError(f"{where}.{place}: column {col!r} is not listed under 'kolom'")
    c.warnings += lint(c)
    return c


def lint(c: Contract) -> list[str]:
    """Well-formed but suspicious statements."""
    out = [f"datasets.{c.name}.sama_nilai: {a} is compared with itself" for a, b in c.equal_pairs if a == b]
    out += [f"datasets.{c.name}.urutan_waktu: [{a}, {b}] demands event time >= load time"
            for a, b in c.ordered_pairs if a == c.event_time and b == c.load_time]
    return out


def load_contracts(path: str) -> dict[str, Contract]:
    """Every contract of a YAML (or JSON) file, by name."""
    try:
        import yaml
    except ImportError as exc:                      # pragma: no cover
        raise ContractError("reading contract files needs PyYAML") from exc
    if not os.path.exists(path):
        raise ContractError(f"no contract file at {path}")
    with open(path, encoding="utf-8") as fh:
        doc = _expand(yaml.safe_load(fh) or {})
    blocks = doc.get("datasets") or {}
    if not blocks:
        raise ContractError(f"{path} has no dataset under 'datasets:'")
    return {n: parse_contract(n, b, doc.get("default")) for n, b in blocks.items()}
