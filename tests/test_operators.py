"""Operators against brute force on small tables."""

import itertools
import json
import math
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellum.functions import fuzzy
from vellum.functions import text as X
from vellum.functions.profile import Profile
from vellum.operators import browse, catalogue, features, graph, layout, link, merge, records, rules
from vellum.plans.registry import OperatorRegistry
from vellum.sources import readers, sinks
from vellum.streaming import upsert as streaming


def test_components_by_union_find(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 460)] + [(500, k) for k in range(501, 560)] + [(7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: find(n) for n in parent}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("radius", [0, 5, 9])
def test_hash_join_is_exact(spark, radius):
    random.seed(radius)
    h = [random.getrandbits(64) for _ in range(60)]
    h += [x ^ sum(1 << b for b in random.sample(range(64), k)) for x, k in zip(h, itertools.cycle(range(12)))]
    signed = [x - (1 << 64) if x >> 63 else x for x in h] + [None]
    d = spark.createDataFrame(list(enumerate(signed)), "id int, h long")
    near = {(i, j) for i in range(len(h)) for j in range(i + 1, len(h)) if (h[i] ^ h[j]).bit_count() <= radius}
    assert {tuple(r) for r in graph.hash_edges(d, "id", "h", radius, F.lit(True)).collect()} == near
    joined = {r.id: r.component for r in graph.duplicate_groups(d.withColumn("sha", F.lit("")), "id", "sha", "h", radius).collect()}
    again = {r.node: r.root for r in graph.components(spark.createDataFrame(sorted(near) or [(0, 0)], "u int, v int")).collect()}
    assert joined == {i: again.get(i, i) for i in range(len(signed))}


def test_aspect_limits_the_hash_join(spark):
    d = spark.createDataFrame([(1, 5, 100, 100), (2, 5, 92, 100), (3, 5, 9199, 10000)], "id int, h long, w int, ht int")
    from vellum.functions.vision import aspect_close

    near = graph.hash_edges(d, "id", "h", 5, aspect_close(F.col("a.w"), F.col("a.ht"), F.col("b.w"), F.col("b.ht")))
    assert {tuple(r) for r in near.collect()} == {(1, 2), (2, 3)}


def test_upsert_policies(spark):
    old = spark.createDataFrame([("a", "x", None), ("b", "", 2), ("c", "z", 3)], "key string, t string, n int")
    new = spark.createDataFrame([("a", None, 9), ("b", "y", None), ("d", "q", 4)], "key string, t string, n int")
    run = lambda p: {r.key: (r.t, r.n) for r in records.upsert(old, new, policy=p).collect()}
    assert run("replace") == {"a": (None, 9), "b": ("y", None), "c": ("z", 3), "d": ("q", 4)}
    assert run("fill") == {"a": ("x", 9), "b": ("y", 2), "c": ("z", 3), "d": ("q", 4)}
    assert run("prefer_new") == {"a": ("x", 9), "b": ("y", 2), "c": ("z", 3), "d": ("q", 4)}
    with pytest.raises(ValueError):
        records.upsert(old, new, policy="no")


def test_numbering_and_keys(spark):
    d = spark.createDataFrame([(i, (i * 37) % 101) for i in range(101)], "a int, b int")
    got = {r.b: r.id for r in records.numbered(d, [F.col("b")], "w").collect()}
    assert got == {b: f"w{b + 1:04d}" for b in range(101)}
    d = spark.createDataFrame([("k", 1), ("k", 2), ("m", 3)], "k string, o int")
    assert sorted(r.unique_key for r in records.suffixed(d, "k", ["o"]).collect()) == ["k", "k#2", "m"]


def test_work_rules(spark):
    p = Profile(given=("Ada",), family="Stone")
    cases = [
        ("ab", "length"), ("Exhibition of 1920", "junk"), ("in winter", "fragment"), ("Ada at work", "name"), ("Some Book of Four Decades", "publication"), ("Q12345", "identifier"),
        ("The Studio Building", "garbled"), ("June 12", "date"), ("One, Two, Three, Four", "punctuation"), ("Untitled", "generic"), ("Ice House", None), (None, "length"),
    ]
    rows = [(t, None, None, ["http://wikidata/x"], "high") for t, _ in cases] + [("Old Year", 1890, None, None, None), ("Weak", None, None, [], "low"), ("Untitled", 1920, None, None, None)]
    d = spark.createDataFrame(rows, "title string, year int, collection string, sources array<string>, confidence string")
    got = [r.reason for r in rules.works(d.coalesce(1), p).collect()]
    assert got == [r for _, r in cases] + ["year", "weak", None]
    kept, gone = rules.kept_and_rejected(d, [rules.Rule("no title", F.col("title").isNull())])
    assert (kept.count(), [r.reason for r in gone.collect()]) == (14, ["no title"])


def test_survivors_follow_trust_then_riches(spark):
    rows = [
        (0, 1, "web", "a", "A", None, None, 10, 10, "low", "n1", "web.org", None), (1, 1, "museum", "b", "", 1920, None, 20, 20, None, None, None, "http://m"),
        (2, 1, "museum", "c", "C", 1921, "oil", 20, 20, "high", "n2", None, "http://m"), (3, 2, "other", "d", None, 0, "", None, None, None, None, "s", None),
    ]
    schema = "_ord int, component int, _group string, key string, title string, year int, medium string, width int, height int, confidence string, notes string, source string, page_url string"
    d = spark.createDataFrame(rows, schema).withColumns({"local_path": F.col("key"), "image_url": F.lit(None).cast("string"), "sha256": F.lit(None).cast("string")})
    got = {r.component: r for r in merge.survivors(d, "component", ["museum"]).collect()}
    one, two = got[1], got[2]
    assert (one.key, one.title, one.year, one.medium, one.confidence, one.label_status) == ("b", "C", 1921, "oil", "high", "labelled")
    assert (one.sources, one.page_urls, one.duplicates, one.notes, one.members) == (["museum", "web.org"], ["http://m"], ["a", "c"], "n1 | n2", 3)
    assert (two.title, two.year, two.medium, two.confidence, two.notes, two.label_status) == (None, None, None, "low", None, "unlabelled")


def brute_link(items, works):
    out = {}
    for i, it, iy in items:
        cands = []
        generic = bool(__import__("re").match(X.GENERIC, it))
        for w, wt, wy, o in works:
            if generic or __import__("re").match(X.GENERIC, wt):
                if iy and wy and iy == wy and it == wt:
                    cands.append((100.0, o, w, wy))
                continue
            s = fuzzy.title_score(it, wt)
            if iy and wy:
                gap = abs(iy - wy)
                if gap > 1 or s < (99 if gap else 88):
                    continue
            elif s < 96:
                continue
            cands.append((s, o, w, wy))
        cands.sort(key=lambda c: (-c[0], c[1]))
        years = {c[3] for c in cands if c[0] >= cands[0][0] - 2}
        out[i] = (None, 0.0) if not cands or (iy is None and len(years) > 1) else (cands[0][2], cands[0][0])
    return out


def test_link_by_brute_force(spark):
    random.seed(8)
    words = "north south lake house winter barn red ice mountain street bay island".split()
    works = [(f"w{i}", " ".join(random.sample(words, random.randint(1, 4))), random.choice([None, 1920, 1921, 1922]), i) for i in range(120)] + [("g1", "untitled", 1920, 200), ("g2", "untitled", None, 201)]
    items = []
    for i in range(200):
        t = random.choice(works)[1]
        if random.random() < 0.4:
            k = random.randrange(len(t))
            t = t[:k] + random.choice("aeiou") + t[k + random.randint(0, 1) :]
        items.append((i, t, random.choice([None, 1920, 1921, 1922, 1923])))
    items += [(900, "untitled", 1920), (901, "untitled", None), (902, "", 1920)]
    got = {r.item_id: (r.work_id, r.score) for r in link.link(spark.createDataFrame(items, "item_id int, norm string, year int"), spark.createDataFrame(works, "work_id string, norm string, year int, ord int")).collect()}
    expected = brute_link(items, works)
    assert got.keys() == expected.keys()
    for i, (w, s) in expected.items():
        assert got[i][0] == w and got[i][1] == pytest.approx(s), i


def test_lookup(spark):
    works = spark.createDataFrame([("w1", "Red Barn", 1920, ["Old Barn"], 1), ("w2", "Red Barn", 1930, None, 2), ("w3", "Blue Lake", 1921, ["Red Barn"], 3)], "work_id string, title string, year int, alt_titles array<string>, ord int")
    asked = spark.createDataFrame([(1, "Red Barn", 1921), (2, "Blue Lak", None)], "query_id int, text string, year int")
    got = {(r.query_id, r.place): (r.work_id, r.score) for r in link.lookup(asked, works, 3).collect()}
    assert got[1, 1] == ("w3", 100.0) and got[2, 1] == ("w3", pytest.approx(94.12)) and got[1, 2][0] == "w1"


def test_merge_and_fold_works(spark):
    rows = [
        ("lake", 1920, None, "Lake", None, ["a", "b"], 1), ("lake", 1920, None, "LAKE", "7", ["b", "c", "d", "e"], 2), ("lake", None, None, "Lake", None, ["z"], 3),
        ("barn", None, "X", "Barn", None, ["q"], 4), ("barn", 1921, None, "Barn", None, ["r"], 5), ("sky", None, None, "Sky", None, ["s"], 6), ("sky", 1920, None, "Sky", None, [], 7), ("sky", 1930, None, "Sky", None, [], 8),
    ]
    d = spark.createDataFrame(rows, "norm string, year int, collection string, title string, inventory_no string, sources array<string>, ord int").withColumn("medium", F.lit(None).cast("string"))
    m = catalogue.merge_works(d)
    first = next(r for r in m.collect() if r.ord == 1)
    assert (first.title, first.inventory_no, first.sources) == ("Lake", "7", ["a", "b", "c", "d"])
    got = {r.ord: r.sources for r in catalogue.fold_undated(m).collect()}
    assert sorted(got) == [1, 4, 5, 6, 7, 8] and got[1] == ["a", "b", "c", "d"] and got[5] == ["r"]
    ids = {r.ord: r.id for r in catalogue.with_ids(m).collect()}
    assert ids[1] == "w0001" and len(set(ids.values())) == 7


def test_primary(spark):
    rows = [("a", "w", "s1", 10, 1, 1), ("b", "w", "s2", 20, 2, 2), ("c", "w", "s3", 20, 1, 3), ("d", None, "s9", 5, 1, 4), ("e", None, "s9", 5, 1, 5)]
    got = {r.item_id: (r.primary, r.copies) for r in catalogue.with_primary(spark.createDataFrame(rows, "item_id string, work_id string, sha string, pixels long, rank int, ord int")).collect()}
    assert got == {"a": (False, 3), "b": (False, 3), "c": (True, 3), "d": (True, 2), "e": (False, 2)}


def test_index_fold(spark):
    rows = [
        ("Lake", 1920, "1920", "medium", ["u1"], "first", 1), ("lake", 1921, "1921-22", "high", ["u1", "u2"], None, 2), ("Lake II", 1930, None, "low", [], None, 3), ("Lake", 1935, None, "low", ["u3"], None, 4),
        ("Barn", None, None, "low", None, None, 5), ("Barn", 1919, "1919", "low", None, None, 6), ("Lake Superior Shore", 1925, None, "low", None, None, 7),
    ]
    d = spark.createDataFrame(rows, "title string, year int, year_range string, confidence string, sources array<string>, notes string, ord int")
    none = F.lit(None).cast("string")
    d = d.withColumns({"title_key": X.title_key(F.col("title")), "alt_titles": F.lit(None).cast("array<string>"), "alt_keys": F.lit(None).cast("array<string>"), **dict.fromkeys(("medium", "dimensions", "collection", "inventory_no", "wikidata_id"), none)})
    got = {r.bucket: r for r in catalogue.fold_index(d).collect()}
    lake = got["lake|1920"]
    assert sorted(got) == ["barn|x", "lake superior shore|1925", "lake|1920"]
    assert (lake.alt_titles, lake.confidence, lake.sources, lake.notes, lake.year_range) == (["Lake II"], "high", ["u1", "u2", "u3"], "first; alt year 1930; alt year 1935", "1920")
    assert got["barn|x"].year == 1919


def test_browse(spark):
    rows = [("1", "Élan", 1920, "A", 10, 10, True), ("2", "barn", None, "B", 5, 5, True), ("3", "Barn", 0, None, 7, 7, False)]
    d = spark.createDataFrame(rows, "id string, title string, year int, source string, w int, h int, primary boolean").withColumns({"work_id": F.lit(None).cast("string"), "work_year": F.lit(None).cast("int")})
    order = lambda *a: [r.id for r in d.orderBy(*browse.wall_order(*a)).collect()]
    assert order("year") == ["1", "2", "3"] and order("size", True) == ["1", "3", "2"] and order("title")[:2] in (["2", "3"], ["3", "2"])
    assert [r.id for r in browse.search(browse.in_mode(d), " BARN ", "title", "year").collect()] == ["2"] and browse.search(d, "0", "year").count() == 1
    cap = d.select(browse.caption(F.col("title"), F.col("year"), F.lit(None).cast("string"), F.col("source"), F.lit(2), F.lit("http://p"))).collect()
    assert cap[0][0] == '<b>Élan</b><span>1920 · A · 2 files · <a href="http://p" target="_blank" rel="noopener">source</a></span>'


def test_features(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(k * 5, 1, (30, 3)) for k in range(3)])
    d = spark.createDataFrame([(i, v.tolist(), i // 30) for i, v in enumerate(x)], "id int, v array<double>, cluster int")
    z = np.array([r.v for r in features.standardized(d, "v", 3).orderBy("id").collect()])
    assert z == pytest.approx((x - x.mean(0)) / x.std(0))
    m = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    own = np.arange(90) // 30
    s = []
    for i in range(90):
        a = m[i, own == own[i]].sum() / 29
        b = min(m[i, own == k].mean() for k in range(3) if k != own[i])
        s.append((b - a) / max(a, b))
    assert features.silhouette(d, "v").first()[0] == pytest.approx(np.mean(s))
    groups = {}
    for r in features.kmeans(d.drop("cluster"), "v", 3, 3).collect():
        groups.setdefault(r.cluster, set()).add(r.id // 30)
    assert sorted(map(len, groups.values())) == [1, 1, 1]
    plane = {r.id: (r.u, r.v) for r in features.plane(d, "v").collect()}
    for k in range(3):
        part = x[own == k] - x[own == k].mean(0)
        axes = np.linalg.svd(part, full_matrices=False)[2][:2]
        axes = axes * np.sign(axes[np.arange(2), np.abs(axes).argmax(1)])[:, None]
        y = part @ axes.T
        y = (y - y.min(0)) / (np.ptp(y, axis=0) + 1e-9)
        assert np.array([plane[i] for i in range(30 * k, 30 * k + 30)]) == pytest.approx(y, abs=1e-6)
    few = d.where("id < 2")
    assert {tuple(r)[1:] for r in features.plane(few, "v").collect()} == {(0.5, 0.5)}


def test_mosaic(spark):
    rows = [("g", i, a, i) for i, a in enumerate([1.0, 0.5, 2.0, None, 1.5, 0.7, 3.0, 1.0])]
    got = layout.mosaic(spark.createDataFrame(rows, "group string, id int, aspect double, ord int"), 600, 180, focus=2, opened=True).collect()
    by = {}
    for r in got:
        by.setdefault(r.row, []).append(r)
    for tiles in by.values():
        tiles.sort(key=lambda r: r.x)
        assert tiles[0].x == 0 and tiles[-1].x + tiles[-1].w == 600 and len({t.h for t in tiles}) == 1
        assert all(b.x == a.x + a.w + layout.GAP for a, b in zip(tiles, tiles[1:]))
    assert len(got) == 8


def test_bubbles_and_overlaps(spark):
    rng = np.random.default_rng(1)
    rows = [("g", i, float(x), float(y), 40.0, 30.0) for i, (x, y) in enumerate(rng.uniform(0, 150, (25, 2)))]
    d = spark.createDataFrame(rows, "group string, id int, cx double, cy double, w double, h double")
    before = layout.overlaps(d.select("group", "id", (F.col("cx") - F.col("w") / 2).alias("x"), (F.col("cy") - F.col("h") / 2).alias("y"), "w", "h"), 50.0).count()
    brute = sum(abs(a[2] - b[2]) < 40 and abs(a[3] - b[3]) < 30 for a, b in itertools.combinations(rows, 2))
    out = layout.bubbles(d)
    corner = out.agg(F.min("x"), F.min("y")).first()
    assert before == brute and layout.overlaps(out, 50.0).count() < before / 5 and tuple(corner) == pytest.approx((8, 8))


def test_sources(spark, tmp_path):
    folder = tmp_path / "swarm" / "a"
    folder.mkdir(parents=True)
    lines = [{"key": "k1", "title": "A", "year": 1920}, {"key": "k2", "title": "É"}, {"key": "k1", "title": "B"}]
    (folder / "metadata.jsonl").write_text("\n".join(json.dumps(x, ensure_ascii=False) for x in lines) + "\n\n")
    got = {r.key: (r.title, r.year, r._group) for r in readers.read_keyed(spark, str(tmp_path / "swarm")).collect()}
    assert got == {"k1": ("B", None, "a"), "k2": ("É", None, "a")}
    (folder / "bad.jsonl").write_text('{"key": "k9", "title": "ok"}\n{broken\n')
    assert {r.key for r in readers.read_keyed(spark, str(folder / "bad.jsonl"), tolerant=True).collect()} == {"k9"}
    with pytest.raises(Exception):
        readers.read_keyed(spark, str(folder / "bad.jsonl")).collect()
    assert spark.createDataFrame([("./data/x/a.jpg",)], "p string").select(readers.local_key(F.col("p"))).first()[0] == "x/a.jpg"


def test_sinks_read_back(spark, tmp_path):
    d = spark.createDataFrame([("k", "T;x", ["a", "b"], None)], "key string, title string, sources array<string>, notes string")
    sinks.write_csv(d, str(tmp_path / "csv"), ["key", "title", "sources", "year"])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first().asDict() == {"key": "k", "title": "T;x", "sources": "a;b", "year": None}
    sinks.write_records(d, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).first().sources == ["a", "b"]
    works, images = spark.createDataFrame([("w1", "A")], "id string, title string"), spark.createDataFrame([("i1", 3)], "id string, w int")
    sinks.write_assignment(sinks.catalogue_object(works, images, built="now"), "CATALOG", str(tmp_path / "js"))
    got = readers.read_assigned(spark, str(tmp_path / "js"), "struct<works: array<struct<id: string, title: string>>, images: array<struct<id: string, w: int>>>", "images")
    assert [tuple(r) for r in got.collect()] == [("i1", 3)]


def test_html_and_json_readers(spark):
    page = '<h2>Barn, 1920</h2><ul><li><a href="/x">Lake</a>, 1921</li></ul><img src="/icon.png"><img src="/thumb/a/F.jpg/200px-F.jpg"><url><loc> http://s/1 </loc></url>'
    d = spark.createDataFrame([(1, page)], "id int, html string")
    assert [(r.title, r.year) for r in readers.html_list(d).collect()] == [("Lake", 1921)]
    assert [(r.title, r.year) for r in readers.html_list(d, pattern=readers.HEADED).collect()] == [("Barn", 1920)]
    assert d.select(readers.page_image(F.col("html"))).first()[0] == "/a/F.jpg"
    assert [r.loc for r in readers.html_values(d, "loc", readers.SITEMAP).collect()] == ["http://s/1"]
    j = spark.createDataFrame([('{"results": {"bindings": [{"a": {"value": "1"}}, {"b": {"value": "2"}}]}}',)], "t string")
    assert [tuple(r) for r in j.select(F.inline(readers.flat_bindings(F.col("t"), ["a", "b"]))).collect()] == [("1", None), (None, "2")]
    j = spark.createDataFrame([('{"p1": {"Paintings": [{"id": 1}]}}', '{"x": [{"@id": "http://i/full/1.jpg"}]}')], "t string, n string")
    assert j.select(readers.paged_items(F.col("t"), "struct<id: int>", "Paintings")[0]["items"][0]["id"], readers.nested_image("n")).first() == (1, "http://i/full/1.jpg")
    assert readers.image_size(b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (640).to_bytes(4) + (480).to_bytes(4)) == (640, 480) and readers.image_size(b"no") is None


def test_images_are_read_by_header(spark, tmp_path):
    png = lambda w, h, n: b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + w.to_bytes(4) + h.to_bytes(4) + bytes(n)
    (tmp_path / "a").mkdir()
    for name, data in {"a/ok.png": png(640, 480, 9000), "small.png": png(640, 480, 10), "thin.png": png(640, 79, 9000), "broken.jpg": bytes(9000), "note.txt": bytes(9000)}.items():
        (tmp_path / name).write_bytes(data)
    got = readers.read_images(spark, str(tmp_path)).collect()
    assert [(r.path.rsplit("/", 1)[1], r.width, r.height) for r in got] == [("ok.png", 640, 480)]


def test_rules_for_media_and_lots(spark):
    p = Profile(given=("Ada",), family="Stone", others=(r"ada p\.? stone",), birth_year=1885, last_year=1970)
    rows = [("Ada Stone Lake", "image/png", 500, "Paintings of lakes"), ("Lake", "image/jpeg", 500, "Paintings"), ("Ada P. Stone Lake", "image/png", 500, "Paintings"), ("x", "text/html", 500, None), ("Ada Stone at her studio", "image/png", 500, None), ("Lake", "image/png", 20, None), ("Lake", "image/png", 200, None)]
    d = spark.createDataFrame(rows, "t string, m string, w int, c string").coalesce(1)
    got = [tuple(r.l) for r in d.select(rules.file_level(F.col("t"), F.col("m"), F.col("w"), F.col("c"), p).alias("l")).collect()]
    assert got == [("high", "name and category"), ("medium", "category"), ("reject", "other person"), ("reject", "type"), ("reject", "photograph"), ("reject", "small"), ("reject", "no sign")]
    d = spark.createDataFrame([("Ada Stone, Lake",), ("Ada P Stone",), ("by Ada Stone or Ada P. Stone 1885-1970",), (None,)], "t string").coalesce(1)
    assert [r[0] for r in d.select(rules.attributed_lot(F.col("t"), p)).collect()] == [True, False, True, False]
    assert [tuple(r[0]) for r in d.select(rules.attribution(F.col("t"), p)).collect()] == [(True, "named"), (False, "other person"), (False, "other person"), (False, "no name")]
    d = spark.createDataFrame([("Ada Stone", "n"), ("Other", "n"), (None, None)], "a string, n string").coalesce(1)
    assert [r[0] for r in d.select(rules.mismatch_note(F.col("a"), p, F.col("n"))).collect()] == ["n", "n; listed artist: Other", None]


def test_stream_upsert_runs_again(spark, tmp_path):
    source, table, log = (str(tmp_path / n) for n in ("in", "table", "log"))
    for batch in ([(1, 1, "a"), (1, 2, "b"), (2, 3, "c")], [(2, 9, "d"), (3, 4, "e")]):
        spark.createDataFrame(batch, "key int, _ord int, v string").coalesce(1).write.mode("append").parquet(source)
        rows = spark.readStream.schema("key int, _ord int, v string").parquet(source)
        streaming.stream_upsert(rows, table, log).awaitTermination()
    newest = max(int(r.epoch) for r in spark.read.parquet(table).select("epoch").distinct().collect())
    assert {(r.key, r.v) for r in spark.read.parquet(f"{table}/epoch={newest}").collect()} == {(1, "b"), (2, "d"), (3, "e")}


def test_registry(spark):
    r = OperatorRegistry()
    r.register("double", lambda d, by=2: d.withColumn("x", F.col("x") * by))
    d = spark.createDataFrame([(1,)], "x int")
    assert r.apply(d, "double", ("double", {"by": 5})).first().x == 10 and r.names("double") == ["double"]
    with pytest.raises(KeyError):
        r.names("double,none")
    with pytest.raises(ValueError):
        r.register("double", lambda d: d)


def test_traversal_meets_cycles_once(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("b", "d")], "u string, v string")
    got = {r.node: r.depth for r in graph.reachable(edges, spark.createDataFrame([("a",)], "node string")).collect()}
    assert got == {"a": 0, "b": 1, "c": 2, "d": 2} and math.isfinite(len(got))


@pytest.mark.parametrize("least", [96.0, 99.0])
def test_texts_of_a_sufficient_ratio_share_a_meeting_key(spark, least):
    rng = random.Random(int(least))
    pairs = []
    for _ in range(1500):
        a = "".join(rng.choice("abc d1") for _ in range(rng.choice((1, 2, 9, 26, 60, 99, 101, 118, 121, 130))))
        b = list(a)
        for _ in range(rng.randrange(7)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(2)] = rng.choice(("", "a", "d"))
        pairs.append((a, "".join(b)))
    d = spark.createDataFrame(pairs, "a string, b string")
    d = d.select("a", "b", F.arrays_overlap(link.meeting_keys(F.col("a"), least, False), link.meeting_keys(F.col("b"), least, True)).alias("met"))
    close = [r for r in d.withColumns({"la": link.letters(F.col("a")), "lb": link.letters(F.col("b"))}).withColumn("near", link._within("a", "b", "la", "lb", least)).collect() if r.a and r.b and fuzzy.ratio(r.a, r.b) >= least]
    assert len(close) > 200 and any(r.a != r.b for r in close)
    assert all(r.met and r.near for r in close)


def test_plain_text_and_normed_titles_of_whole_tables_by_brute_force(spark):
    import html
    import re
    import unicodedata

    from vellum import catalogue_queries

    sf = "/root/testdata/sf0.001"
    source = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in catalogue_queries.queries()["f2_plain_text"](spark, sf).collect():
        shown = re.sub(r"(?is)<!--.*?-->|<!doctype[^>]*>", "<x>", re.sub(r"(?is)<(script|style)\b.*?</\1>", "<x>", source[r.page_id]))
        assert r.text == " ".join(p for p in (html.unescape(p).strip() for p in re.split(r"<[^>]+>", shown)) if p)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r.norm for r in catalogue_queries.queries()["f3_normed_titles"](spark, sf).collect()}
    assert got.keys() == texts.keys()
    for k, v in texts.items():
        plain = unicodedata.normalize("NFKD", v or "").lower().replace("'", "")
        words = "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in plain).split()
        assert got[k] == " ".join(w for w in words if w not in X.STOP_WORDS)


@pytest.mark.parametrize("block", [3, 2048])
def test_silhouette_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(features, "BLOCK", block)
    rng = np.random.default_rng(4)
    x, c = np.vstack([rng.normal(size=(14, 3)), np.zeros((8, 3))]), [i % 3 for i in range(21)] + [7]
    m = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    of = np.array(c)
    each = []
    for i in range(len(c)):
        own = (of == of[i]).sum()
        a = m[i, of == of[i]].sum() / (own - 1) if own > 1 else None
        b = min(m[i, of == k].mean() for k in set(c) - {c[i]})
        each.append(0.0 if a is None else (b - a) / max(a, b))
    d = spark.createDataFrame([(i, v.tolist(), k) for i, (v, k) in enumerate(zip(x, c, strict=True))], "id int, v array<double>, cluster int")
    assert features.silhouette(d, "v").first()[0] == pytest.approx(np.mean(each))
    assert features.silhouette(d.limit(0), "v").first()[0] is None


@pytest.mark.parametrize("joint", [1, 2, 3])
def test_hashes_within_the_radius_share_a_joint_key(spark, joint):
    rng = random.Random(joint)
    rows = []
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(6)))
        rows.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    d = spark.createDataFrame(rows, "a long, b long")
    assert d.where(~F.arrays_overlap(graph.bands(F.col("a"), 5, joint=joint), graph.bands(F.col("b"), 5, joint=joint))).count() == 0


def test_bubbles_stay_within_a_width(spark):
    tiles = spark.createDataFrame([("g", i, float(i % 3 * 200), 40.0 * (i // 3), 30.0, 20.0) for i in range(9)], "group string, id int, cx double, cy double, w double, h double")
    wide = layout.bubbles(tiles, rounds=10).toPandas()
    close = layout.bubbles(tiles, rounds=10, within=300.0).toPandas()
    assert (wide.x + wide.w).max() > 400 and (close.x + close.w).max() <= 300 + 8
    one = layout.bubbles(tiles.where("id = 0"), within=10.0).toPandas()
    assert (one.x[0], one.y[0]) == (8, 8)


def test_index_fold_of_many_families(spark):
    """Buckets by a look at each earlier one, over titles that start one another and share other titles."""
    rng = np.random.default_rng(5)
    stems = ["".join(rng.choice(list("abc"), rng.integers(1, 5))) for _ in range(150)]
    rows = []
    for i in range(2500):
        title = stems[rng.integers(150)] * int(rng.integers(1, 4)) + ("" if rng.random() < 0.6 else " " + "xyzxyzxyzx"[: rng.integers(1, 10)])
        alt = [stems[rng.integers(150)] + " other"] if rng.random() < 0.05 else None
        rows.append((f"{title}{rng.integers(40)}", alt, None if rng.random() < 0.3 else int(rng.integers(1915, 1925)), i))
    d = spark.createDataFrame(rows, "title string, alt_keys array<string>, year int, ord int")
    none = F.lit(None).cast("string")
    d = d.withColumns({"title_key": F.col("title"), "alt_titles": F.col("alt_keys"), "year_range": none, "sources": F.array(F.col("ord").cast("string")), "confidence": F.lit("low"), "notes": none, **dict.fromkeys(("medium", "dimensions", "collection", "inventory_no", "wikidata_id"), none)})
    held = []  # own key, all keys, year, members
    for key, alt, year, i in rows:
        fits = [b for b in held if key in b[1] or (abs(len(b[0]) - len(key)) <= 8 and (b[0].startswith(key) or key.startswith(b[0])))]
        near = [b for b in fits if year is not None and b[2] is not None and abs(b[2] - year) <= 1]
        undated = [b for b in fits if b[2] is None]
        if not fits:
            at = [key, set(), None, []]
            held.append(at)
        else:
            at = fits[0] if year is None else min(near, key=lambda b: abs(b[2] - year)) if near else undated[0] if undated else fits[0]
        at[1] |= {key, *(alt or [])}
        at[2] = year if at[2] is None else at[2]
        at[3].append(str(i))
    got = {tuple(r.sources): r.year for r in catalogue.fold_index(d).collect()}
    assert len(held) > 100 and max(len(b[3]) for b in held) > 5
    assert got == {tuple(b[3]): b[2] for b in held}


def plain_separate(c, size, focus=None):
    """Each pair in turn, one by one; the number of pairs looked at."""
    for i in range(len(c)):
        for j in range(i + 1, len(c)):
            over = (size[i] + size[j]) / 2 + layout.GAP - np.abs(c[j] - c[i])
            if over.min() > 0:
                axis = int(over[1] <= over[0])
                away = np.copysign(over[axis], c[j, axis] - c[i, axis] + 0.0)
                mine, its = (0.5, 0.5) if focus not in (i, j) else (layout.STILL, 1 - layout.STILL) if i == focus else (1 - layout.STILL, layout.STILL)
                c[i, axis] -= away * mine
                c[j, axis] += away * its


@pytest.mark.parametrize("focus", [None, 3])
def test_boxes_are_pushed_as_pair_by_pair(focus):
    rng = np.random.default_rng(2)
    for n, span in ((0, 1), (1, 1), (40, 60), (70, 900)):
        c, size = np.floor(rng.random((n, 2)) * span), 10 + 40 * rng.random((n, 2))
        plain = c.copy()
        for _ in range(4):
            plain_separate(plain, size, focus)
            layout.separate(c, size, focus)
        assert (c == plain).all()


def test_groups_of_boxes_side_by_side_are_pushed_as_alone():
    """Groups of unlike sizes, boxes far off and without a place or size, and a box in focus in some."""
    rng = np.random.default_rng(6)
    groups = [(np.floor(rng.random((n, 2)) * span), 10 + 40 * rng.random((n, 2))) for n, span in ((60, 80), (31, 60), (1, 5), (45, 4000))]
    groups[0][0][7], groups[1][0][3, 0], groups[1][1][4, 1], groups[3][0][5] = 1e9, np.nan, np.nan, groups[3][0][6]
    for focus in (None, np.array([2, 0, 0, 9])):
        c, size = np.full((60, 4, 2), np.nan), np.ones((60, 4, 2))
        for g, (some, own) in enumerate(groups):
            c[: len(some), g], size[: len(own), g] = some, own
        alone = [some.copy() for some, _ in groups]
        for _ in range(3):
            layout.separate(c, size, None if focus is None else focus * 4 + np.arange(4))
            for g, some in enumerate(alone):
                plain_separate(some, groups[g][1], None if focus is None else int(focus[g]))
        assert all(np.array_equal(c[: len(some), g], some, equal_nan=True) for g, some in enumerate(alone))


def test_steps_of_a_pass_do_not_grow_with_pairs():
    """Lines of Python run for a group where all boxes overlap: some for each sum of two places, none for a pair."""
    lines = [0]

    def trace(frame, event, _):
        if frame.f_code is not layout.separate.__code__:
            return None
        lines[0] += event == "line"
        return trace

    c, size = np.random.default_rng(7).random((500, 2)), np.full((500, 2), 30.0)
    before = sys.gettrace()
    sys.settrace(trace)
    try:
        layout.separate(c, size)
    finally:
        sys.settrace(before)
    assert lines[0] < 120 * len(c)


def test_bubbles_of_many_groups_and_batches(spark):
    """Each group as if it were alone, where a task has several, a null one, and groups that go over batches."""
    rng = np.random.default_rng(8)
    rows = [(g, i, *map(float, rng.uniform(0, 60, 2)), 30.0, 20.0) for g, n in (("a", 30), (None, 12), ("b", 7), ("c", 25), ("d", 1)) for i in rng.permutation(n).tolist()]
    d = spark.createDataFrame(rows, "group string, id int, cx double, cy double, w double, h double")
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 4)
    try:
        got = {(r.group, r.id): (r.x, r.y, r.w, r.h) for r in layout.bubbles(d.coalesce(1), rounds=3, relax=1, focus=5, within=200.0, together=10).collect()}
        alone = {}
        for g in ("a", None, "b", "c", "d"):
            alone |= {(r.group, r.id): (r.x, r.y, r.w, r.h) for r in layout.bubbles(d.where(F.col("group").eqNullSafe(F.lit(g))), rounds=3, relax=1, focus=5, within=200.0).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    assert got == alone and len(got) == len(rows)
    big = 2**60 + 1  # ids beyond a double's digits, next to null ones
    d = spark.createDataFrame([(1, big, 0.0, 0.0, 30.0, 20.0), (1, big + 1, 1.0, 1.0, 30.0, 20.0), (None, None, None, 0.0, 30.0, 20.0)], "group long, id long, cx double, cy double, w double, h double")
    odd = {r.id: r.x for r in layout.bubbles(d.coalesce(1), rounds=2).collect()}
    assert set(odd) == {big, big + 1, None} and odd[big] == 8 and odd[None] is None and layout.bubbles(d.limit(0)).count() == 0
    assert layout.side_by_side([5, 100, 60, 49], 1000) == [[1, 2], [3], [0]]
    assert layout.side_by_side([60, 100, 70, 70], 150) == [[1], [2, 3], [0]]


def test_groups_of_boxes_are_dealt_to_tasks(spark):
    """Small rows that make much work: not gathered in a few tasks."""
    tiles = spark.range(200).select((F.col("id") % 50).alias("group"), "id", *(F.lit(v).alias(k) for k, v in (("cx", 1.0), ("cy", 2.0), ("w", 3.0), ("h", 4.0))))
    tasks = layout.bubbles(tiles, rounds=1).select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 2


def test_overlaps_are_told_once_and_never_gathered(spark):
    rng = np.random.default_rng(4)
    rows = [(k % 2, k, *(float(v) for v in (*(rng.random(2) * 300 - 150), *np.floor(rng.random(2) * 90)))) for k in range(120)]
    d = spark.createDataFrame(rows, "group int, id int, x double, y double, w double, h double")
    got = layout.overlaps(d, 32.0)
    brute = [(p[0], p[1], q[1]) for p in rows for q in rows if p[0] == q[0] and p[1] < q[1] and p[2] < q[2] + q[4] and q[2] < p[2] + p[4] and p[3] < q[3] + q[5] and q[3] < p[3] + p[5]]
    assert sorted(map(tuple, got.collect())) == sorted(brute)
    assert "Aggregate" not in got._jdf.queryExecution().optimizedPlan().toString()  # pairs are many more than boxes


@pytest.mark.parametrize("block", [16384, 40])
def test_forest_of_hashes_joins_what_all_pairs_join(spark, monkeypatch, block):
    monkeypatch.setattr(graph, "HASHES", block)
    rng = np.random.default_rng(6)
    base = rng.integers(-(2**63), 2**63, 60)
    hashes = [*base.tolist(), *(int(h) ^ sum(1 << int(b) for b in rng.integers(0, 62, 17)) for h in base for _ in range(2)), int(base[0]), int(base[3]), None]
    d = spark.createDataFrame([(k, h) for k, h in enumerate(hashes)], "id int, h long").withColumn("sha", F.lit(None).cast("string"))
    root = list(range(len(hashes)))
    for _ in root:
        for a, b in itertools.combinations(range(len(hashes) - 1), 2):
            if root[a] != root[b] and ((hashes[a] ^ hashes[b]) & (2**64 - 1)).bit_count() <= 15:
                root[a] = root[b] = min(root[a], root[b])
        if root == (root := [root[r] for r in root]):
            break
    forest = graph.hash_forest(d, "id", "h", 15)
    assert forest.count() < len(hashes) * (1 if block > 1000 else 10)
    assert {r.id: r.component for r in graph.duplicate_groups(d, "id", "sha", "h", 15).collect()} == dict(enumerate(root))


def test_copies_of_a_vector_are_one_point_of_the_silhouette(spark):
    """Shuffled blocks grow with distinct points and not with their rows; a cluster of equal rows has distance 0."""
    d = spark.createDataFrame([(i, [float(i % 4), 1.0], i % 2) for i in range(400)], "id int, v array<double>, cluster int")
    sizes = []
    held = features.stage
    features.stage = lambda t, name: sizes.append(held(t, name)) or sizes[-1]
    try:
        got = features.silhouette(d, "v").first()[0]
    finally:
        features.stage = held
    assert sizes[0].count() == 4
    x, c = np.arange(400) % 4, np.arange(400) % 2
    m = np.abs(x[:, None] - x)
    a, b = (m * (c[:, None] == c)).sum(1) / 199, (m * (c[:, None] != c)).sum(1) / 200
    assert got == pytest.approx(((b - a) / np.maximum(a, b)).mean())


def test_copies_of_items_and_works_are_linked_once(spark, monkeypatch):
    """Rows of one text and year are one row before they meet, and texts meet before their years do."""
    titles = [f"{a} {b} harbour {n}" for a in ("red", "blue") for b in ("winter", "summer") for n in range(4)]
    works = [(f"w{k}", titles[k % 16], 1900 + k // 16 % 30 * 2, k) for k in range(960)]
    items = [(k, titles[k % 16], 1900 + k // 16 % 30 * 2) for k in range(1440)] + [(2000, None, 1900), (2001, "nothing like it", 1901), (2002, titles[3], 0)]
    seen = {}
    held = link.stage
    monkeypatch.setattr(link, "stage", lambda t, name: seen.setdefault(name, held(t, name)))
    got = {r.item_id: (r.work_id, r.score) for r in link.link(spark.createDataFrame(items, "item_id int, norm string, year int"), spark.createDataFrame(works, "work_id string, norm string, year int, ord int")).collect()}
    assert got == {k: (f"w{k % 480}", 100.0) for k in range(1440)} | {k: (None, 0.0) for k in (2000, 2001, 2002)}
    assert seen["link-works"].count() == 480 and seen["link-items"].count() == 482
    assert seen["link-alike"].count() <= 16 * 16


def test_queries_hand_short_batches_to_python(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10000)
    from vellum import catalogue_queries

    catalogue_queries.queries()["f3_normed_titles"](spark, "/root/testdata/sf0.001")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 2000
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").removesuffix("b")) <= 8 << 20
