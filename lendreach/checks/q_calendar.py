"""Calendar and run rules, each over every day the tables span."""

from pyspark.sql import functions as F

from lendreach.checks.registry import query
from lendreach.operators import calendar as cal_ops


def _received_days(v):
    return v.leads0.select(F.to_date("received_time").alias("run_date")).distinct()


DAYS = "d AS (SELECT DISTINCT CAST(received_time AS DATE) AS run_date FROM leads0)"


@query("K01_run_allowed", "leads0 cal holidays", f"""WITH {DAYS} SELECT 'weekday' AS policy, run_date, CASE WHEN weekend + holiday < 1 THEN 1 ELSE 0 END AS allowed FROM d JOIN cal ON ori_date = run_date
  UNION ALL SELECT 'named', run_date, CASE WHEN weekend = 0 AND strftime(run_date, '%m%d') NOT IN ('0101', '1225') AND run_date NOT IN
   (SELECT holiday FROM holidays WHERE starts_with(description, 'Thanksgiving')) THEN 1 ELSE 0 END FROM d JOIN cal ON ori_date = run_date
  UNION ALL SELECT 'biweekly', run_date, CASE WHEN isodow(run_date) = 3 AND floor((day(run_date) - 1) / 7) + 1 IN (1, 3) THEN 1 ELSE 0 END FROM d JOIN cal ON ori_date = run_date""")
def _(v):
    days, out = _received_days(v), None
    for p in ("weekday", "named", "biweekly"):
        part = cal_ops.run_allowed(v.cal, v.holidays, days, p).select(F.lit(p).alias("policy"),
                                                                      "run_date", "allowed")
        out = part if out is None else out.unionByName(part)
    return out


@query("K02_due_targets", "leads0", f"""WITH {DAYS} SELECT run_date, CASE WHEN isodow(run_date) > 5 THEN NULL WHEN isodow(run_date) <= 2 THEN run_date + 3 ELSE run_date + 5 END AS first_date,
  CASE WHEN isodow(run_date) > 5 THEN NULL WHEN isodow(run_date) = 1 THEN run_date + 11 ELSE run_date + 13 END AS second_date,
  CASE WHEN isodow(run_date) > 5 THEN NULL ELSE run_date + 7 END AS third_date FROM d""")
def _(v):
    return cal_ops.due_targets(_received_days(v))


@query("K03_received_window", "leads0 cal", f"""WITH {DAYS} SELECT 'first' AS touch, run_date, operation_date AS std_date, run_date - 1 AS end_date FROM d
  JOIN cal ON ori_date = run_date - 1 WHERE isodow(run_date) <= 5 AND operation_date <= run_date - 1
  UNION ALL SELECT 'second', run_date, operation_date, CASE WHEN isodow(run_date) = 1 THEN run_date - 4 ELSE run_date - 2 END FROM d
  JOIN cal ON ori_date = CASE WHEN isodow(run_date) IN (3, 4, 5) THEN run_date - 2 ELSE run_date - 4 END
  WHERE isodow(run_date) <= 5 AND operation_date <= CASE WHEN isodow(run_date) = 1 THEN run_date - 4 ELSE run_date - 2 END""")
def _(v):
    d = _received_days(v)
    a = cal_ops.received_window(v.cal, d).withColumn("touch", F.lit("first"))
    b = cal_ops.received_window(v.cal, d, 2, -2, 4, -4).withColumn("touch", F.lit("second"))
    return a.unionByName(b)


@query("K05_rollover_dates", "leads0 cal holidays", f"""WITH {DAYS} SELECT run_date, run_date AS business_date FROM d UNION ALL
  SELECT run_date, n FROM (SELECT run_date, (SELECT min(ori_date) FROM cal WHERE ori_date > run_date AND weekend = 0) AS n FROM d) z
  JOIN cal ON ori_date = n WHERE holiday = 1 AND n NOT IN (SELECT holiday FROM holidays WHERE description IN ('Thanksgiving Day', 'Christmas', 'New Year''s Day'))""")
def _(v):
    return cal_ops.rollover_dates(v.cal, v.holidays, _received_days(v))
