"""Restartable stages, the sink, stage figures, lookups, correlations, premiums, persona batches."""
import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from hiresight.operators import personas as PE
from hiresight.operators import quality, segments
from hiresight.plans import stages as ST
from hiresight.sources.raw import read_stage, save_stage


def raw_frame(spark, n=40):
    rows = [(str(i % 30), f"Junior Python developer {i}", "Acme" if i % 2 else "Beta", "RUB" if i % 5 else "USD", float(100000 + 1000 * i),
             "Москва" if i % 3 else "Казань", "true" if i % 4 == 0 else "false", "2025-11-2%dT10:00:00+03:00" % (i % 9),
             "2025-11-30T12:00:00+00:00", "junior" if i % 2 else "unknown") for i in range(n)]
    return spark.createDataFrame(rows, "vacancy_id string, title string, company string, currency string, salary_mid double, city string, "
                                       "has_python string, published_at_iso string, scraped_at_utc string, grade string")


def test_chain_is_restarted_after_a_kill(spark, tmp_path, monkeypatch):
    out, raw, made = str(tmp_path / "out"), raw_frame(spark), []
    save, features = ST.save_stage, ST.FE.assemble_features

    def killed(df, path, fmt=None):
        made.append(path.split("/")[-2])
        if made == ["clean", "features"]:
            df.limit(3).write.parquet(path)                                  # half-written, and never committed
            raise KeyboardInterrupt
        save(df, path, fmt)

    monkeypatch.setattr(ST, "save_stage", killed)
    with pytest.raises(KeyboardInterrupt):
        ST.run_stages(raw, out)
    res = ST.run_stages(raw, out)
    assert made == ["clean", "features", "features", "market_view"] and res.reused == ["clean"]
    assert res.features.count() == 30 and res.report
    again = ST.run_stages(raw, out)
    assert again.reused == ["clean", "features", "market_view"] and len(made) == 4 and again.report == res.report
    want = sorted(map(str, res.market.collect()))
    monkeypatch.setattr(ST, "build_market_view", lambda f: (_ for _ in ()).throw(AssertionError))
    ST.run_stages(raw, out)                                                  # the view is there: not built
    monkeypatch.undo()
    fs, path = ST.shared_path(spark, f"{out}/market_view")
    fs.delete(path, True)
    rebuilt = ST.run_stages(raw, out)
    assert rebuilt.reused == ["clean", "features"] and sorted(map(str, rebuilt.market.collect())) == want
    other = ST.run_stages(raw_frame(spark, 35), out)                          # other input: everything anew
    assert other.reused == [] and ST.run_stages(raw, out, drop_threshold=0.99).reused == []
    plain = ST.run_stages(raw)
    assert sorted(map(str, plain.market.collect())) == want and plain.reused == []
    assert features is ST.FE.assemble_features


def test_sink_makes_boolean_like_strings_boolean(spark, tmp_path):
    df = spark.createDataFrame([("Yes", "true", "x", None, "1", "unknown"), ("no", None, "true", None, "0", None), (" n/a ", "FALSE", "no", None, None, "")],
                               "a string, salary_gross string, mixed string, empty string, digits string, markers string")
    save_stage(df, str(tmp_path / "s"))
    got = read_stage(spark, str(tmp_path / "s"))
    assert dict(got.dtypes) == {"a": "boolean", "salary_gross": "boolean", "mixed": "string", "empty": "string", "digits": "boolean", "markers": "string"}
    assert {tuple(r) for r in got.collect()} == {(True, True, "x", None, True, "unknown"), (False, None, "true", None, False, None), (None, False, "no", None, None, "")}


def test_stage_figures(spark):
    modes = spark.createDataFrame([("Remote", None, 1.0, "RUB"), ("hybrid", 5.0, None, None), (None, None, None, "USD"), ("office", None, None, "RUB")],
                                  "work_mode string, salary_from double, salary_mid double, currency string")
    flags = spark.createDataFrame([(True,), (None,)], "is_remote boolean")
    cells = spark.createDataFrame([(1.0, 3), (0.0, 1)], "remote_share double, vacancy_count long")
    t = {r.stage: r for r in quality.stage_table([("m", modes), ("f", flags), ("c", cells), ("none", spark.range(2))], weight_col="vacancy_count").collect()}
    assert (t["m"].rows, t["m"].columns, t["m"].salary_share, t["m"].non_rub_share, t["m"].remote_share, t["m"].unknown_share) == (4, 4, 0.5, 0.5, 0.5, 0.25)
    assert (t["f"].remote_share, t["f"].salary_share, t["f"].unknown_share) == (0.5, None, None)
    assert t["c"].remote_share == 0.75 and t["none"].remote_share is None
    assert quality.stage_summary("c", cells).first().remote_share == 0.5
    assert quality.stage_summary("c", cells.withColumn("vacancy_count", F.lit(0)), "vacancy_count").first().remote_share == 0.5


def test_lookup_of_cells(spark):
    cells = spark.createDataFrame([("a", 1, 5.0), ("a", 1, 4.0), ("b", None, 1.0), ("c", 2, None)], "k string, j int, v double")
    asks = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "b", None), (4, "c", 2), (5, "z", 9), (6, None, 1)], "id int, k string, j int")
    got = segments.lookup_cells(cells, asks, ["k", "j"], ["v"])
    assert got.columns == ["id", "k", "j", "v"] and {r.id: r.v for r in got.collect()} == {1: 4.0, 2: 4.0, 3: None, 4: None, 5: None, 6: None}


def test_frequency_order(spark):
    df = spark.createDataFrame([(True, True, None), (False, True, None), (None, True, None)], "domain_b boolean, domain_a boolean, domain_c boolean")
    assert segments.frequency_order(df) == ["a", "b", "c"] and segments.frequency_order(df, "x_") == []


def test_correlations_of_a_hundred_columns(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(200, 100)) + 1e6
    x[:, 1] = 3.0
    x[r.random(x.shape) < 0.1] = np.nan
    x[:, 2] = np.nan
    df = spark.createDataFrame([[None if math.isnan(v) and i % 2 else float(v) for i, v in enumerate(row)] for row in x], [f"c{i}" for i in range(100)]
                               if False else ", ".join(f"c{i} double" for i in range(100)))
    got = {(a, b): c for a, b, c in segments.correlation_matrix(df).collect()}
    assert len(got) == 100 * 100
    for a, b in [(0, 3), (3, 0), (5, 5), (98, 99), (40, 41), (1, 4), (2, 4), (2, 2)]:
        both = ~np.isnan(x[:, a]) & ~np.isnan(x[:, b])
        u, v = x[both, a], x[both, b]
        want = None if not both.any() or np.ptp(u) == 0 or np.ptp(v) == 0 else np.corrcoef(u, v)[0, 1]
        c = got[f"c{a}", f"c{b}"]
        assert (c is None) if want is None else abs(c - want) < 1e-8, (a, b, c, want)
    assert segments.correlation_matrix(df.limit(0)).where("corr is not null").count() == 0


def test_premium_equals_medians_and_explodes_no_rows(spark):
    r = random.Random(3)
    rows = [(r.choice([None, 0.0, float("nan"), r.gauss(0, 3), float(r.randrange(-3, 4)), 1e5 * r.random()]), r.choice([None, True, False]), r.random() < 0.3, False, i < 20)
            for i in range(400)]
    names = ["skill_a", "skill_b", "skill_none", "skill_few"]
    df = spark.createDataFrame(rows, "m double, " + ", ".join(f"{n} boolean" for n in names))
    out = segments.skill_premium(df, [*names, "skill_absent"], "m", 0)
    got = {x.skill: x for x in out.collect()}
    for j, c in enumerate(names):
        side = lambda has: [x[0] for x in rows if x[0] is not None and x[0] == x[0] and bool(x[j + 1]) == has]  # noqa: E731, B023
        want = [statistics.median(s) if s else None for s in (side(True), side(False))]
        assert [got[c].median_with, got[c].median_without] == want and got[c].count_with_skill == sum(bool(x[j + 1]) for x in rows)
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    first_aggregate = max(i for i, line in enumerate(plan) if "Aggregate" in line)
    assert not any("Generate" in line for line in plan[first_aggregate:])        # rows are counted before anything is unfolded
    assert segments.skill_premium(df, ["skill_absent"], "m").count() == 0 and segments.skill_premium(df.limit(0), names, "m").count() == 0


def test_persona_batch_equals_single_runs(spark):
    r = random.Random(1)
    pick = lambda *xs: r.choice(xs)
    rows = [(pick("a", "b", None), pick("junior", "lead"), pick("X", "Y"), pick("remote", "office"), pick(1, 2, 3, None), r.random() < 0.5, pick(True, False, None)) for _ in range(300)]
    df = spark.createDataFrame(rows, "primary_role string, grade string, city_tier string, work_mode string, size int, is_big boolean, skill_q boolean")
    people = [PE.Persona(f"p{i}", "", ["skill_q"] * (i % 2), pick("a", "b", "zz"), pick(None, "junior", "lead"), pick(None, "X"), pick(None, "remote"),
                         pick({}, {"size": 2}, {"size": [1, 3]}, {"is_big": True, "gone": 5}, {"size": "many"})) for i in range(12)]
    got = {s.persona: s for s in PE.batch_segments(df, people, ["skill_q"], 30).collect()}
    gaps = {g.persona: g for g in PE.batch_skill_gaps(df, people, 0.0, None, 30, ["skill_q"]).collect()}
    for p in people:
        if p.constraints.get("size") == "many":                                 # no value of that type: matches nothing
            continue
        one = PE.filter_by_target(df, p, 30)
        assert (got[p.name].relaxed, got[p.name].market_n) == (one.relaxed_filters, one.sample_size), p
        share = one.filtered_df.agg(F.avg(F.coalesce(F.col("skill_q"), F.lit(False)).cast("int"))).first()[0]
        assert abs(gaps[p.name].market_share - share) < 1e-12 and gaps[p.name].persona_has == bool(p.current_skills)
    assert got[next(p.name for p in people if p.target_role == "zz")].level > 0
    assert [p.name for p in PE.PRESETS] == ["data_student", "switcher_bi", "mid_data_analyst"]
    many = [PE.Persona(f"q{i}", "", [], "a", "junior", f"T{i}") for i in range(3000)]
    assert PE.batch_segments(df, many, [], 30).agg(F.countDistinct("persona")).first()[0] == 3000
