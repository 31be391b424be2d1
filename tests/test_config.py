import pytest

from tidewatch import config
from tidewatch.config import Config, ConfigError


def test_defaults_are_valid():
    c = Config()
    assert (c.window_minutes, c.candidate_capacity, c.topn, c.alpha, c.min_days) == (5, 20_000, 100, 0.1, 2)


@pytest.mark.parametrize("bad", [
    {"window_minutes": 7}, {"slot_minutes": 0}, {"start_mode": "later"}, {"start_mode": "fixed"}, {"large_enabled": False, "offhours_enabled": False},
    {"bytes_quantile": 1.0}, {"candidate_capacity": 0}, {"topn": 3_000}, {"min_days": 8}, {"ttl_days": 0}, {"max_pairs": 999}, {"alpha": 0.0},
    {"stable_delay_minutes": -1}, {"device_id": "12345"}, {"delivery_guarantee": "twice"}, {"kafka_enabled": True, "checkpoint_enabled": False}])
def test_out_of_range(bad):
    with pytest.raises(ConfigError):
        Config(**bad)


def test_properties_and_overrides(tmp_path):
    f = tmp_path / "a.properties"
    f.write_text("# comment\nwindow.size.minutes = 10 \nrule.large.enabled=false\nalert.device.id: 654321\nrule.offhours.topn=7\n")
    c = config.load(["--config", str(f)], {"window.size.minutes": "15", "history.pair.ttl.days": "3"})
    assert (c.window_minutes, c.large_enabled, c.device_id, c.topn) == (15, False, "654321", 7)
    assert c.ttl_days == 7  # overrides only replace keys that the file has
    assert config.load([f"--config={f}"]).window_minutes == 10
    assert config.load([], env={"TIDEWATCH_CONFIG": str(f)}).topn == 7
    with pytest.raises(ConfigError):
        config.from_properties({"window.size.minutes": "ten"})
