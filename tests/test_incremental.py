"""Releases loaded again and again must hold what a full read gives, and read no more than they need."""

import os
import random

import pytest

from codetree.plans.hierarchy import hierarchy_from_releases, refresh_hierarchy
from codetree.sources import incremental
from codetree.sources import tabular_xml as xml
from tests import releases


def text(code, desc):
    return releases.release("x", releases.chapter("1", "Bones (L00-L99)", releases.section("a", "b (L20-L29)", releases.diag(code, desc))))


def documents(docs):
    return sorted((r.year, r.file.rpartition("/")[2], str(r.chapter)) for r in docs.collect())


def judged(bad):
    return sorted((str(r.year), r.file.rpartition("/")[2], r.reason) for r in bad.collect())


def same_as_full(spark, folder, store):
    docs, bad = incremental.releases(spark, store)
    whole, whole_bad = xml.read_releases(spark, folder)
    assert documents(docs) == documents(whole) and judged(bad) == judged(whole_bad)


def outcomes(rows):
    return {r.file.rpartition("/")[2]: (r.outcome, r.parsed_in) for r in rows.collect()}


def test_only_new_and_changed_files_are_read(spark, tmp_path, monkeypatch):
    folder, store = tmp_path / "in", str(tmp_path / "store")
    folder.mkdir()
    read = []
    raw = incremental.read_raw
    monkeypatch.setattr(incremental, "read_raw", lambda s, paths, *a: read.append(sorted(p.rpartition("/")[2] for p in paths)) or raw(s, paths, *a))

    def put(name, body, age=0):
        (folder / name).write_text(body)
        os.utime(folder / name, (1_700_000_000 + age, 1_700_000_000 + age))

    def load():
        read.clear()
        rows = incremental.load(spark, str(folder), store)
        same_as_full(spark, str(folder), store)
        return outcomes(rows)

    put("r2031.xml", text("L20", "one"))
    put("r2032.xml", text("L21", "two"))
    put("r2033.xml", "<ICD10CM.tabular><version>")
    put("readme.xml", text("L22", "no year"))
    put("empty.xml", "<x/>")
    first = load()
    assert first == {"r2031.xml": ("parsed", 1), "r2032.xml": ("parsed", 1), "r2033.xml": first["r2033.xml"], "readme.xml": ("no year", 1), "empty.xml": ("no release", 1)}
    assert first["r2033.xml"][0] in ("not parsed", "no release")
    # Nothing has changed, which takes no number.
    assert load() == {} and not read
    # A touched file is hashed and not read, one that is mended and a new one are read.
    put("r2031.xml", text("L20", "one"), age=50)
    put("r2033.xml", text("L23", "three"), age=50)
    put("r2034.xml", text("L24", "four"))
    assert load() == {"r2031.xml": ("parsed", 1), "r2033.xml": ("parsed", 2), "r2034.xml": ("parsed", 2)}
    assert read == [["r2033.xml", "r2034.xml"]]
    # A file changes, another of the same year comes before it by name, one goes.
    put("r2031.xml", text("L20", "one more"), age=90)
    put("a2032.xml", text("L29", "earlier by name"))
    (folder / "r2034.xml").unlink()
    assert load() == {"r2031.xml": ("parsed", 3), "a2032.xml": ("parsed", 3), "r2034.xml": ("gone", 2)}
    assert read == [["a2032.xml", "r2031.xml"]]
    # It comes back as it was.
    put("r2034.xml", text("L24", "four"))
    assert load() == {"r2034.xml": ("parsed", 4)}
    assert incremental.drop_superseded(spark, store) == []
    put("r2033.xml", text("L23", "again"), age=99)
    load()
    assert incremental.drop_superseded(spark, store) == [2]
    same_as_full(spark, str(folder), store)


def test_a_load_that_died_is_done_again(spark, tmp_path, monkeypatch):
    folder, store = tmp_path / "in", str(tmp_path / "store")
    folder.mkdir()
    (folder / "r2031.xml").write_text(text("L20", "one"))

    def die(parsed):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "_outcomes", die)
        with pytest.raises(RuntimeError):
            incremental.load(spark, str(folder), store)
    assert incremental.releases(spark, store)[0].count() == 0
    (folder / "r2031.xml").write_text(text("L20", "other"))
    assert outcomes(incremental.load(spark, str(folder), store)) == {"r2031.xml": ("parsed", 1)}
    same_as_full(spark, str(folder), store)


@pytest.mark.parametrize("seed", range(2))
def test_random_changes(spark, tmp_path, seed):
    rng = random.Random(seed)
    folder, store = tmp_path / "in", str(tmp_path / "store")
    folder.mkdir()
    for step in range(4):
        for year in range(2031, 2036):
            name = folder / f"{rng.choice('ab')}{year}.xml"
            kind = rng.random()
            if kind < 0.3 and name.exists():
                name.unlink()
            elif kind < 0.7:
                name.write_text(text(f"L2{rng.randrange(10)}", f"step {step}"))
        incremental.load(spark, str(folder), store)
        same_as_full(spark, str(folder), store)


def test_refresh_builds_changed_years_only(spark, tmp_path):
    folder, store, target = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "out")
    folder.mkdir()
    for year in (2031, 2032, 2033):
        (folder / f"r{year}.xml").write_text(text("L20", f"bone {year}"))
    assert refresh_hierarchy(spark, str(folder), store, target) == ([2031, 2032, 2033], [])

    def written():
        return {y: sorted(p.name for p in (tmp_path / "out" / f"year={y}").glob("*.parquet")) for y in (2031, 2032, 2033, 2034)}

    before = written()
    assert refresh_hierarchy(spark, str(folder), store, target) == ([], [])
    (folder / "r2032.xml").write_text(text("L21", "other"))
    (folder / "r2033.xml").unlink()
    (folder / "r2034.xml").write_text(text("L24", "new"))
    assert refresh_hierarchy(spark, str(folder), store, target) == ([2032, 2034], [2033])
    after = written()
    assert after[2031] == before[2031] and after[2032] != before[2032] and not after[2033] and after[2034]
    whole = hierarchy_from_releases(xml.read_releases(spark, str(folder))[0])
    columns = [c for c in whole.columns if c != "update_date"]
    found = spark.read.parquet(target).select(columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.select(columns).collect()))
