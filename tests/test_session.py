from types import SimpleNamespace

import pytest

from cardwatch import session


def fake(**settings):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: settings.get(k, d)))


def test_the_shared_folder_is_the_one_the_session_names():
    spark = fake(**{"spark.checkpoint.dir": "s3a://shared/cp/", "spark.master": "yarn"})
    assert session.shared_root(spark) == "s3a://shared/cp"
    one, two = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert one != two and one.startswith("s3a://shared/cp/cardwatch/x-")


def test_a_cluster_without_one_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(fake(**{"spark.master": "yarn"}))


def test_a_local_session_gets_its_own():
    assert session.shared_root(fake(**{"spark.master": "local[2]"})).startswith("file:///")


def test_settings_are_visible_in_a_real_session(spark):
    assert spark.conf.get("spark.master").startswith("local")
    assert spark.conf.get("spark.checkpoint.dir").startswith("file:")
