from spindrel import config
from spindrel.plans import examples as X
from spindrel.sources import exports


def test_settings_from_the_environment():
    s = config.Settings.from_env({"SCRAPE_CONCURRENCY": "3", "PROFESSORS_TIMEOUT": "9", "MODULE_LINKS_MIN": "5", "SCRAPE_PROXY": "http://p:1", "SCRAPE_PROXY_USER": "u", "SCRAPE_PROXY_PASS": "w"})
    assert (s.pages.workers, s.people.timeout, s.least_links, s.pages.proxy, s.pages.timeout, s.catalogue.timeout) == (3, 9.0, 5, "http://u:w@p:1", 45.0, 180.0)
    assert config.Settings.from_env({}).least_links == 1000


def test_health_checks():
    assert config.healthy_module(X.MODULE_EN, "u") is None and config.healthy_module(X.ERROR_PAGE, "u")
    assert config.healthy_event(X.EVENT, "u") is None and config.healthy_event(X.ERROR_PAGE, "u")


def test_exports_and_clearing(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", None)], "key string, n int")
    exports.export_roster(rows, spark.range(1), rows, str(tmp_path / "x"))
    assert spark.read.json(str(tmp_path / "x" / "data")).count() == 2
    for name in ("1.json", "2.json", "3.txt"):
        (tmp_path / name).write_text("{}")
    assert exports.clear(spark, str(tmp_path)) == 2 and exports.clear(spark, str(tmp_path / "none")) == 0 and (tmp_path / "3.txt").exists()
