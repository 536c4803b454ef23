"""A6 mapping loading, plan-time warnings and vendor matching."""
import yaml

from feedloom.config import MAPPINGS_DIR, bundled, load_mappings, match_rules_df, validate_mapping
from feedloom.operators.files import vendor_match


def test_load_dir_and_file(tmp_path):
    (tmp_path / "b.yaml").write_text(yaml.safe_dump({"vendor_code": "B", "file_match": ["bee"]}))
    (tmp_path / "a.yaml").write_text(yaml.safe_dump({"vendors": [{"vendor_code": "A1"}, {"vendor_code": "A2"}]}))
    (tmp_path / "c.yaml").write_text(yaml.safe_dump({"something": "else"}))
    (tmp_path / "d.yml").write_text(yaml.safe_dump({"vendor_code": "ignored, wrong suffix"}))
    assert [m["vendor_code"] for m in load_mappings(tmp_path)] == ["A1", "A2", "B"]
    assert [m["vendor_code"] for m in load_mappings(tmp_path / "b.yaml")] == ["B"]


def test_vendor_match_first_mapping_wins(spark):
    rules = match_rules_df(spark, load_mappings(MAPPINGS_DIR / "vendors.yaml"))
    files = spark.createDataFrame([("EXAMPLE1_data_7.xlsx",), ("x_Data_y.xlsx",), ("other.xlsx",)], "file_name string")
    got = {r.file_name: (r.vendor_code, r.status) for r in vendor_match(files, rules).collect()}
    assert got == {"EXAMPLE1_data_7.xlsx": ("Example 1", "matched"), "x_Data_y.xlsx": ("Example 2", "matched"), "other.xlsx": (None, "skipped")}
    assert vendor_match(files, rules.limit(0)).filter("status = 'skipped'").count() == 3


def test_validate_mapping_warnings():
    cfg = dict(bundled("parts_layered"))
    cfg["category"] = {"strategy": "layered", "regex_scan": {"rules": [{"category_type": "x", "any_regex": ["(unclosed"]}]}}
    warns = validate_mapping(cfg)
    assert any("invalid" in w for w in warns)
    assert any("names no mapped field" in w for w in warns)
