import numpy as np

from chronoforge.plans import catalog
from tests.conftest import SF001


def test_holdout_comparison_consistent(spark):
    table, skill = catalog.holdout_comparison_frames(spark, SF001)
    t = table.toPandas()
    s = skill.first()
    assert len(t) > 0 and t["time"].dt.month.eq(6).all()
    ec, eb = t["error_candidate"], t["error_baseline"]
    np.testing.assert_allclose(s["rmse_candidate"], np.sqrt((ec ** 2).mean()), rtol=1e-10)
    np.testing.assert_allclose(s["mae_baseline"], eb.abs().mean(), rtol=1e-10)
    np.testing.assert_allclose(s["skill_rmse_vs_baseline"],
                               1 - np.sqrt((ec ** 2).mean()) / np.sqrt((eb ** 2).mean()), rtol=1e-10)
