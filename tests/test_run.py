"""Landed JSON files, the full run and its written tables."""

from __future__ import annotations

import json
import logging
from dataclasses import replace

import pytest

from hardwood.operators.quality import order_violations
from hardwood.plans import run as plans
from hardwood.plans.analyses import ANALYSES
from hardwood.plans.star import ConstraintViolation
from hardwood.sinks import scratch, tables, versions
from hardwood.sinks.tables import (
    STAR_SCHEMAS,
    export,
    read_catalog,
    read_result,
    read_star,
    write_star,
    write_table,
)
from hardwood.sources import landed
from tests.test_star import team_game


def dump(path, rows, upper):
    path.parent.mkdir(parents=True, exist_ok=True)
    change = str.upper if upper else str.lower
    path.write_text(json.dumps([{change(k): v for k, v in row.items()} for row in rows], indent=4))


def land(folder, upper=True, games=None):
    """A landing with two seasons, as indented JSON arrays with one file per call."""
    if games is None:
        games = {
            "1999-00": [
                team_game("0029900001", 1, 2, "1999-11-02", 100),
                team_game("0029900001", 2, 1, "1999-11-02", 90, home=False, wl="L"),
            ],
            "2000-01": [
                team_game("0020000001", 2, 1, "2000-11-02", 100, season="22000"),
                team_game("0020000001", 1, 2, "2000-11-02", 90, home=False, wl="L", season="22000"),
            ],
        }
    teams = [
        {"id": i, "full_name": f"Team {i}", "abbreviation": a, "nickname": "n", "city": "c",
         "state": "s", "year_founded": 1950}
        for i, a in ((1, "BOS"), (2, "LAL"))
    ]
    dump(folder / "team_static" / "teams_static.json", teams, upper=False)
    base = [{"team_id": i, "team_name": "x", "gp": 1, "w": 1, "l": 0, "w_pct": 1.0} for i in (1, 2)]
    advanced = [
        {"team_id": i, "off_rating": 101.5, "def_rating": 99.0, "net_rating": 2.5, "pace": 97.1, "pie": 0.5}
        for i in (1, 2)
    ]
    for season, rows in games.items():
        dump(folder / "game_logs" / f"{season}_game_logs.json", rows, upper)
        for place in ("Home", "Road"):
            stats = folder / "team_stats"
            dump(stats / f"{season}_{place}_Base_team_stats.json", base, upper)
            dump(stats / f"{season}_{place}_Advanced_team_stats.json", advanced, upper)


@pytest.mark.parametrize("upper", [True, False])
def test_reads_either_case_of_keys(spark, tmp_path, upper):
    land(tmp_path, upper)
    log = landed.read_game_log(spark, str(tmp_path / "game_logs"))
    assert sorted((r.game_id, r.team_id, r.pts) for r in log.collect()) == [
        ("0020000001", 1, 90),
        ("0020000001", 2, 100),
        ("0029900001", 1, 100),
        ("0029900001", 2, 90),
    ]
    assert landed.read_teams(spark, str(tmp_path / "team_static")).count() == 2


def test_stats_files_are_routed_by_name(spark, tmp_path):
    land(tmp_path)
    stats = tmp_path / "team_stats"
    row = [{"team_id": 9, "gp": 4, "w": 1, "l": 3, "w_pct": 0.25}]
    dump(stats / "2001-02_Neutral_Base_team_stats.json", row, True)
    dump(stats / "2002-03_Home_Road_Base_Advanced.json", row, True)
    dump(stats / "2003-04_Home_Other_team_stats.json", row, True)
    base = landed.read_team_stats_base(spark, str(stats)).collect()
    assert sorted((r.season, r.location, r.team_id) for r in base if r.team_id != 9) == sorted(
        (season, place, team)
        for season in ("1999-00", "2000-01")
        for place in ("Home", "Road")
        for team in (1, 2)
    )
    assert {(r.season, r.location) for r in base if r.team_id == 9} == {
        ("2001-02", None),
        ("2002-03", "Home"),
    }
    advanced = landed.read_team_stats_advanced(spark, str(stats)).collect()
    assert len(advanced) == 8 and {r.off_rating for r in advanced} == {101.5}


def test_reads_json_lines(spark, tmp_path):
    rows = [team_game("a", 1, 2, "1999-11-02", 100), team_game("a", 2, 1, "1999-11-02", 90)]
    path = tmp_path / "log.json"
    path.write_text("\n".join(json.dumps({k.upper(): v for k, v in row.items()}) for row in rows))
    assert landed.read_game_log(spark, str(path), lines=True).count() == 2


def test_full_run_can_be_repeated(spark, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    land(landing)
    results = plans.run(spark, str(landing), out)
    assert list(results) == list(ANALYSES)
    trend = results["q2_hca_trend"]
    assert trend.uri.startswith(f"{out}/exports/versions/") and trend.uri.endswith("/trend/q2_hca_trend")
    assert trend.rows == read_result(spark, trend).count() == 2
    assert read_catalog(spark, f"{out}/exports") == results
    again = plans.run(spark, str(landing), out)
    assert {name: (r.rows, r.schema) for name, r in again.items()} == {
        name: (r.rows, r.schema) for name, r in results.items()
    }
    assert read_catalog(spark, f"{out}/exports") == again != results
    # The catalog names the star it was made from.
    (star,) = {r.star for r in spark.read.parquet(f"{versions.current(spark, f'{out}/exports')}/manifest").collect()}
    assert star == versions.version_name(versions.current(spark, f"{out}/star"))
    star = read_star(spark, f"{out}/star")
    assert {name: getattr(star, name).count() for name in STAR_SCHEMAS} == {
        "dim_team": 2,
        "dim_season": 2,
        "dim_game": 2,
        "fact_team_game": 4,
        "fact_team_season": 8,
    }
    assert star.fact_team_game.columns == STAR_SCHEMAS["fact_team_game"].names


def bag(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("step", ["build_star", "write_star", "require_valid", "commit"])
def test_a_failed_run_leaves_the_older_star(spark, tmp_path, monkeypatch, step):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    land(landing)
    staging = plans.load(spark, str(landing), out)
    plans.transform(spark, staging, out)
    older = {name: bag(getattr(read_star(spark, f"{out}/star"), name)) for name in STAR_SCHEMAS}

    def fail(*_, **__):
        raise OSError("lost")

    owner = versions if step == "commit" else plans
    with monkeypatch.context() as patch:
        if step == "write_star":  # fails when half of the tables are written
            write = tables.write_table
            patch.setattr(tables, "write_table", lambda df, uri, *a: fail() if "fact" in uri else write(df, uri, *a))
        else:
            patch.setattr(owner, step, fail)
        with pytest.raises(OSError, match="lost"):
            plans.transform(spark, staging, out)
    assert {name: bag(getattr(read_star(spark, f"{out}/star"), name)) for name in STAR_SCHEMAS} == older
    plans.transform(spark, staging, out)
    assert {name: bag(getattr(read_star(spark, f"{out}/star"), name)) for name in STAR_SCHEMAS} == older


def test_a_failed_analysis_leaves_the_older_catalog(spark, tmp_path, monkeypatch):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    land(landing)
    older = plans.run(spark, str(landing), out)
    rows = {name: bag(read_result(spark, result)) for name, result in older.items()}

    def fail(*_):
        raise ArithmeticError("seventh")

    name = list(ANALYSES)[6]
    broken = replace(ANALYSES[name], plan=fail)
    with monkeypatch.context() as patch, pytest.raises(ArithmeticError, match="seventh"):
        patch.setitem(plans.ANALYSES, name, broken)
        plans.export_all(read_star(spark, f"{out}/star"), f"{out}/exports")
    assert read_catalog(spark, f"{out}/exports") == older
    assert {name: bag(read_result(spark, result)) for name, result in older.items()} == rows
    assert read_catalog(spark, f"{out}/nothing") == {}


def test_versions_are_kept_and_removed(spark, tmp_path):
    base, folders = str(tmp_path / "base"), []
    assert versions.current(spark, base) is None
    for i in range(12):
        folders.append(versions.new_version(base))
        spark.range(i).write.parquet(folders[-1])
        if i > 0:
            assert versions.current(spark, base) == folders[i - 1]
        versions.commit(spark, base, folders[-1])
        assert spark.read.parquet(versions.current(spark, base)).count() == i
    # Readers of the version before the last one are not cut off; older ones are gone.
    assert spark.read.parquet(folders[-2]).count() == 10
    assert len(list((tmp_path / "base" / "versions").iterdir())) == 2
    lost = versions.new_version(base)  # written, and never committed
    spark.range(99).write.parquet(lost)
    assert versions.current(spark, base) == folders[-1]


def test_run_refuses_a_broken_landing(spark, tmp_path):
    landing = tmp_path / "landing"
    row = team_game("a", 1, 2, "1999-11-02", 100)
    land(landing, games={"1999-00": [row, row]})
    with pytest.raises(ConstraintViolation, match="fact_team_game key"):
        plans.run(spark, str(landing), str(tmp_path / "out"))
    assert versions.current(spark, f"{tmp_path}/out/star") is None


def test_empty_input_is_warned_about(spark, tmp_path, caplog):
    land(tmp_path / "landing", games={"1999-00": []})
    with caplog.at_level(logging.WARNING):
        plans.load(spark, str(tmp_path / "landing"), str(tmp_path / "out"))
    assert "staging game_log is empty" in caplog.text


def test_star_by_season_reads_back_the_same(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing)
    plain = plans.transform(spark, plans.load(spark, str(landing), str(tmp_path)), str(tmp_path))
    write_star(plain, str(tmp_path / "by_season"), by_season=True)
    assert (tmp_path / "by_season" / "fact_team_game" / "season_id=1999-00").is_dir()
    again = read_star(spark, str(tmp_path / "by_season"))
    for name in STAR_SCHEMAS:
        one, two = getattr(plain, name), getattr(again, name)
        assert one.dtypes == two.dtypes
        assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_export_replaces_and_names_its_place(spark, tmp_path):
    df = spark.range(5)
    assert write_table(df, str(tmp_path / "t")) == 5
    first = export(df, f"{tmp_path}/", "theme", "name")
    assert first == (f"{tmp_path}/theme/name", 5, df.schema.json())
    assert export(spark.range(3), str(tmp_path), "theme", "name") == (first.uri, 3, df.schema.json())
    assert read_result(spark, first).count() == 3


@pytest.mark.parametrize("rows, broken", [
    ([(1, "a"), (1, "b"), (2, None), (2, None), (None, "a"), (None, None)], []),
    ([(1, "b"), (1, "a"), (2, "a")], [1]),
    ([(None, "a"), (1, "a"), (1, None), (1, "a")], [1, 3]),
    ([(3, "a")], []),
    ([], []),
])
def test_order_of_written_rows(spark, tmp_path, rows, broken):
    df = spark.createDataFrame(rows, "x int, y string")
    df.coalesce(1).write.parquet(f"{tmp_path}/one")
    found = order_violations(spark, f"{tmp_path}/one", ["x", "y"]).collect()
    assert [r.row_index for r in found] == broken


def test_order_between_files(spark, tmp_path):
    df = spark.range(1000).repartitionByRange(7, "id").sortWithinPartitions("id")
    df.write.parquet(f"{tmp_path}/sorted")
    assert order_violations(spark, f"{tmp_path}/sorted", ["id"]).isEmpty()
    # Each file is sorted, but every one but the first starts too low.
    spark.range(1000).repartition(7).sortWithinPartitions("id").write.parquet(f"{tmp_path}/files")
    found = order_violations(spark, f"{tmp_path}/files", ["id"]).collect()
    assert len(found) == 6 and {r.row_index for r in found} == {0}
    assert len(order_violations(spark, f"{tmp_path}/sorted", ["-id"]).collect()) == 999


def test_scratch_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = scratch.shared_folder(spark)
    assert folder == named.rstrip("/") if named else folder == scratch.shared_folder(spark)
    assert scratch.scratch_path(spark, "a") != scratch.scratch_path(spark, "a")


def test_mixed_cases_and_floats_for_integers(spark, tmp_path):
    folder = tmp_path / "team_stats"
    dump(folder / "1999-00_Home_Base_a.json", [{"team_id": 1, "gp": 41.0, "w": 2.5, "l": 3.5, "w_pct": 0.5}], True)
    dump(folder / "1999-00_Road_Base_b.json", [{"team_id": 2, "gp": 41, "w": 1, "l": None, "w_pct": 1}], False)
    (folder / "2000-01_Home_Base_c.json").write_text('[{"Team_Id": 3, "Gp": 7, "other": {"x": [1]}}]')
    rows = landed.read_team_stats_base(spark, str(folder)).collect()
    assert sorted((r.team_id, r.season, r.location, r.gp, r.w, r.l, r.w_pct) for r in rows) == [
        (1, "1999-00", "Home", 41, 2, 4, 0.5),
        (2, "1999-00", "Road", 41, 1, None, 1.0),
        (3, "2000-01", "Home", 7, None, None, None),
    ]


OBJECT = '{"team_id": 1, "gp": 41, "w": 2, "l": 3, "w_pct": 0.5}'


def read_stats(spark, tmp_path, text, lines):
    file = tmp_path / "team_stats" / "2000-01_Home_Base_x.json"
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_text(text)
    rows = landed.read_team_stats_base(spark, str(file.parent), lines=lines).collect()
    return [(r.team_id, r.gp, r.w_pct) for r in rows]


@pytest.mark.parametrize("text", [
    OBJECT + OBJECT, f"{OBJECT}, {OBJECT}", OBJECT + " x", OBJECT[:-6], f"[{OBJECT}]", "null", "5", '"x"',
    f"{OBJECT}\n{OBJECT[:-6]}",
])
def test_a_line_that_is_no_single_object_raises(spark, tmp_path, text):
    with pytest.raises(Exception, match="damaged JSON in 2000-01_Home_Base_x.json"):
        read_stats(spark, tmp_path, text, lines=True)


@pytest.mark.parametrize("text", [
    f"[{OBJECT}][{OBJECT}]", f"[{OBJECT}] x", f"[{OBJECT}", OBJECT, f"[{OBJECT}, null]", "[null]", f"[[{OBJECT}]]",
    "", " \n ",
])
def test_a_file_that_is_no_single_array_raises(spark, tmp_path, text):
    with pytest.raises(Exception, match="damaged JSON in 2000-01_Home_Base_x.json"):
        read_stats(spark, tmp_path, text, lines=False)


@pytest.mark.parametrize("lines", [True, False])
def test_values_are_read_as_written(spark, tmp_path, lines):
    wrap = "{}" if lines else "[{}]"
    row = (1, 41, 0.5)
    for text in (OBJECT, OBJECT.upper(), OBJECT.replace("41", '"41.0"'), OBJECT.replace("gp", "Gp"),
                 OBJECT.replace("{", '{"x": {"gp": [7]}, "Y": "team_id", ', 1)):
        assert read_stats(spark, tmp_path, wrap.format(text), lines) == [row]
    assert read_stats(spark, tmp_path, wrap.format('{"TEAM_ID": 1, "Gp": null}'), lines) == [(1, None, None)]
    again = OBJECT.replace("{", '{"team_id": 2, ', 1)
    assert read_stats(spark, tmp_path, wrap.format(again), lines) == [row], "the last of one spelling counts"
    for twice in ('"TEAM_ID": 2, ', '"Gp": null, "GP": 2, '):
        with pytest.raises(Exception, match="key in two spellings in 2000-01_Home_Base_x.json"):
            read_stats(spark, tmp_path, wrap.format(OBJECT.replace("{", "{" + twice, 1)), lines)
    assert read_stats(spark, tmp_path, "\n\n" if lines else "[]", lines) == []


@pytest.mark.parametrize("lines", [True, False])
def test_a_damaged_file_raises_and_is_named(spark, tmp_path, lines):
    landing = tmp_path / "landing"
    land(landing)
    cut = landing / "team_stats" / "2000-01_Road_Base_team_stats.json"
    cut.write_text(cut.read_text()[:-20])
    with pytest.raises(Exception, match="damaged JSON in .*json"):
        if lines:
            landed.read_team_stats_base(spark, str(cut), lines=True).collect()
        else:
            plans.run(spark, str(landing), str(tmp_path / "out"))


def test_release_removes_what_was_written(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "shared_folder", lambda _: str(tmp_path))
    path = scratch.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    scratch.release(spark)
    assert tmp_path.exists() and not list(tmp_path.rglob("*.parquet"))
