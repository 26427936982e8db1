import pytest

from lakegauge.contract import ContractError, load_contracts, parse_contract, unresolved_variables


def one(**kw):
    return {"kolom": ["a", {"nama": "b", "tipe": "integer"}, {"nama": "t", "tipe": "datetime"}], **kw}


def test_short_column_is_required_text():
    c = parse_contract("d", one())
    assert (c.columns[0].kind, c.columns[0].required) == ("string", True)
    assert c.thresholds["toleransi_volume"] == 0.15 and c.lag_days == {"harian": 2.0, "backfill": 260.0}


@pytest.mark.parametrize("bad", [
    {"kolom": []}, {"kolom": ["a", "a"]}, {"kolom": [{"tipe": "string"}]}, {"kolom": [{"nama": "a", "tipe": "text"}]},
    {"kolom": [{"nama": "a", "rentang": [1]}]}, one(sumber={"partisi": "bulanan"}), one(kunci={"granularitas": "detik"}),
    one(kunci={"surrogate": "zz"}), one(kunci={"bisnis": ["a", "zz"]}), one(kunci={"waktu": "zz"}),
    one(kunci={"satuan_waktu": "detik"}), one(kunci={"waktu": "t", "satuan_waktu": "menit"}),
    one(sumber={"sql_server": {"kolom_waktu": "t"}}), one(ukuran_berkas={"rentang": [1, None]}),
    one(ukuran_berkas={"rentang": 5}), one(relasi=[["a"]]), one(relasi=[["a", "zz"]]), one(sama_nilai=[["zz", "a"]]),
    one(urutan_waktu=[["t", "zz"]]), one(flag_dq=[{"flag": "zz"}]), one(flag_dq=[{"flag": "a", "kolom": "zz"}]), "text"])
def test_mistakes_are_refused(bad):
    with pytest.raises(ContractError):
        parse_contract("d", bad)


def test_defaults_merge_but_audit_replaces(tmp_path, monkeypatch):
    monkeypatch.setenv("BUCKET", "lake")
    p = tmp_path / "c.yml"
    p.write_text("""
default:
  ambang: {toleransi_volume: 0.3, batas_kl: 2}
  sla_lag_hari: {harian: 1}
  meta_audit: {wajib: [loaded_at]}
datasets:
  x: {sumber: {s3: "s3://${BUCKET}/x/${UNSET_VAR}"}, ambang: {batas_kl: 3}, sla_lag_hari: {backfill: 9}, kolom: [a]}
  y: {meta_audit: {wajib: []}, kolom: [a]}
""")
    c = load_contracts(str(p))
    assert c["x"].thresholds["toleransi_volume"] == 0.3 and c["x"].thresholds["batas_kl"] == 3
    assert c["x"].lag_days == {"harian": 1.0, "backfill": 9.0}
    assert c["x"].audit_columns == ["loaded_at"] and c["y"].audit_columns == []
    assert c["x"].remote == "s3://lake/x/${UNSET_VAR}" and unresolved_variables(c["x"].remote) == ["UNSET_VAR"]
    with pytest.raises(ContractError):
        load_contracts(str(tmp_path / "none.yml"))
    (tmp_path / "empty.yml").write_text("default: {}")
    with pytest.raises(ContractError):
        load_contracts(str(tmp_path / "empty.yml"))


def test_unknown_keys_and_odd_pairs_are_reported():
    c = parse_contract("d", {
        "kolom": [{"nama": "a", "relasii": 1}, {"nama": "ev", "tipe": "datetime"}, {"nama": "ld", "tipe": "datetime"}],
        "aneh": 1, "kunci": {"waktu": "ev", "waktu_muat": "ld"}, "sama_nilai": [["a", "a"]], "urutan_waktu": [["ev", "ld"]]})
    text = " ".join(c.warnings)
    assert "relasii" in text and "aneh" in text and "itself" in text and "event time >= load time" in text


def test_extra_blocks_become_rules():
    c = parse_contract("d", one(
        validasi={"referential_integrity": [{"kolom": "a", "source_table": "m", "source_column": "code"}],
                  "data_quality": [{"check": "null_percentage", "threshold": 0.3, "columns": ["a"]},
                                   {"check": "duplicate_check", "threshold": 0, "columns": ["b"]},
                                   {"check": "bounds", "columns": ["b"], "validation": "b < 3"}]},
        distribusi=[{"kolom": "a", "expected_values": ["x", "y", "x"]}, {"kolom": "b", "expected_ratio": 0.8}]))
    assert c.master_links == [{"column": "a", "table": "m", "key": "code"}] and c.null_limits == {"a": 0.3}
    assert c.duplicate_limits == [{"columns": ["b"], "threshold": 0}] and c.predicates[0]["expression"] == "b < 3"
    assert c.expected_values == {"a": ["x", "y"]} and c.expected_ratios == {"b": 0.8}
