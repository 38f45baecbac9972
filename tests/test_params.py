import json

import pytest

from sojourn.params import Params


def test_defaults():
    p = Params().check()
    assert (p.default_minutes, p.window_days, p.max_minutes) == (30, 30, 240)
    assert (p.label_a, p.label_b) == ("Gold", "Silver/Bronze")
    assert p.max_orphan_rate == 0.05


@pytest.mark.parametrize(
    "bad,message",
    [
        ({"group_a": ()}, "group_a"),
        ({"group_b": []}, "group_b"),
        ({"group_a": ("Gold",), "group_b": ("Gold", "Silver")}, "exclusive"),
        ({"default_minutes": 0}, "default_minutes"),
        ({"window_days": 0}, "window_days"),
        ({"window_days": -3}, "window_days"),
    ],
)
def test_contradictions(bad, message):
    with pytest.raises(ValueError, match=message):
        Params(**bad).check()


def test_unlimited_window_is_fine():
    assert Params(window_days=None).check().window_days is None


def test_from_mapping_keeps_defaults():
    p = Params.from_mapping(
        {"rebooking": {"tiers_group_a": ["Gold", "Platinum"], "window_days": None},
         "session": None, "environment": "prod"}
    )
    assert p.label_a == "Gold/Platinum" and p.window_days is None
    assert p.default_minutes == 30 and p.environment == "prod"


def test_warehouse_path_follows_environment():
    assert Params().warehouse_path == "warehouse_dev"
    assert Params(environment="staging").warehouse_path == "warehouse_staging"
    assert Params(environment="prod").warehouse_path == "warehouse"
    assert Params(warehouse="/x").warehouse_path == "/x"


def test_from_yaml(tmp_path):
    pytest.importorskip("yaml")
    f = tmp_path / "settings.yaml"
    f.write_text("rebooking:\n  window_days: 60\ndata_quality:\n  max_duration_minutes: 90\n")
    p = Params.from_yaml(str(f))
    assert (p.window_days, p.max_minutes) == (60, 90)
    with pytest.raises(FileNotFoundError):
        Params.from_yaml(str(tmp_path / "none.yaml"))


def test_to_json():
    data = json.loads(Params(window_days=60).to_json())
    assert data["window_days"] == 60 and data["group_b"] == ["Silver", "Bronze"]
