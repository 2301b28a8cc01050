"""Session defaults can be applied to a session the engine did not build."""

from perkspark.session import BUILD_CONF, DEFAULT_CONF, apply_defaults


def test_runtime_defaults_are_modifiable_on_a_live_session(spark):
    # a driver or notebook hands over a running session: only runtime SQL
    # settings may be filled in; static ones belong to BUILD_CONF
    for key in DEFAULT_CONF:
        assert spark.conf.isModifiable(key), key
    for key in BUILD_CONF:
        assert key not in DEFAULT_CONF
    apply_defaults(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
