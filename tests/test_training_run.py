"""P4 end to end on the smallest tables with a tiny tuning budget."""
from brasa.plans.pipelines import training_run
from brasa.plans.queries import DISPATCH_ORDER
from brasa.sources import derived as D
from brasa.sources.artifacts import load_artifacts

SF = "/root/testdata/sf0.001"


def test_training_run(spark, tmp):
    res = training_run(D.fires(spark, SF).where("final_surface_ha >= initial_surface_ha"), D.dispatches(spark, SF), topo=D.topo(spark, SF),
                       weather=D.weather(spark, SF), polygons=D.polygons(spark), run_dir=f"{tmp}/run",
                       dispatch_order=DISPATCH_ORDER, v1_sources=["despachos_a"], v2_sources=["despachos_b"],
                       n_trials=1, max_iter=3)
    m = res["metrics"]
    for k in ("MAE_base_train", "MAE_base_test", "MAE_xgb0_train", "MAE_xgb0_test",
              "MAE_circular_speed_mm_train", "MAE_circular_speed_mm_test"):
        assert k in m and m[k] >= 0
    assert m["df_rows_after_preprocessing"] >= m["df_rows_after_postprocessing"] > 0
    art = load_artifacts(spark, f"{tmp}/run", strict=False)
    assert art["df"].count() == m["df_rows_after_postprocessing"]
    assert art["model"] and art["pi"].count() > 0 and art["meta"]["ratio"] == 3.0
    assert {"prediction_major_axis_speed_mm", "prediction_base", "lo_xgb0"} <= set(art["df"].columns)
