"""Queries: regularisation."""

from sensorcast.operators import regularize as rg
from sensorcast.plans import sql as S
from sensorcast.plans.registry import r6, register
from sensorcast.sources import testdata as td

V = ["ts", "hr", "qfe"]


def hourly_table(spark, sf_dir, series="mod3"):
    return rg.regularize(td.readings(spark, sf_dir, series))


@register("hourly_mean", f"""WITH {S.readings_cte()}, {S.hourly_cte()}
SELECT series_id, utc, {S.r6(V)} FROM h""")
def hourly_mean(spark, sf_dir):
    return r6(rg.hourly_mean(td.readings(spark, sf_dir)))


@register("minute_mean", f"""WITH {S.readings_cte()}, {S.hourly_cte(unit='minute')}
SELECT series_id, utc, {S.r6(V)} FROM h""")
def minute_mean(spark, sf_dir):
    return r6(rg.resample_mean(td.readings(spark, sf_dir), width="1 minute"))


@register("hourly_grid", f"""WITH {S.readings_cte()}, {S.hourly_cte()}, {S.grid_cte()}
SELECT series_id, utc, pos, {S.r6(V)} FROM g""")
def hourly_grid(spark, sf_dir):
    return r6(rg.gap_grid(rg.hourly_mean(td.readings(spark, sf_dir))))


@register("interpolate_linear", f"""WITH {S.hourly_table_sql()}
SELECT series_id, utc, pos, {S.r6(V)} FROM i""")
def interpolate_linear(spark, sf_dir):
    return r6(hourly_table(spark, sf_dir))
