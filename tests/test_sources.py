"""S1 listing over a real folder tree, S3 CSV read, S6 progress log, P1 paths."""
import os
import re


from pyspark.sql import functions as F

from wattline.operators.paths import bill_listing, build_index, path_metadata, path_predicate, read_listing
from wattline.plans.incremental import done_files, read_bills_csv, read_progress
from wattline.sources.rendered import render_bills

FILES = {
    "mallA/7. Recibos CFE/LOCALES/2024/a.pdf": True,
    "mallA/7. Recibos CFE/b.PDF": True,
    "mallA/7. Recibos CFE/LOCALES/1985-2024/2021/g.pdf": True,
    "mallA/Otros/c.pdf": False,                       # other folder of the mall
    "mallA/0. X/7. Recibos CFE/d.pdf": False,         # pruned at the mall level
    "mallA/7. Recibos CFE/e.txt": False,              # not a pdf
    "7. Recibos CFE/f.pdf": True,                     # bills folder right under the root
    "top.pdf": False,
}


def test_bill_listing_folder_tree(spark, scratch):
    root = os.path.join(scratch, "root")
    for rel in FILES:
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as fh:
            fh.write(b"%PDF-1.4 x")
    listed = bill_listing(spark, root)
    for other in (f"file:{root}", f"file://{root}", f"{root}/../root", f"{root}/"):
        assert listed.exceptAll(bill_listing(spark, other)).count() == 0
        assert bill_listing(spark, other).count() == listed.count()
    got = sorted(os.path.relpath(r.file_path, root) for r in listed.collect())
    assert got == sorted(k for k, v in FILES.items() if v)
    idx = {os.path.relpath(r.file_path, root): r for r in build_index(listed, root).collect()}
    a = idx["mallA/7. Recibos CFE/LOCALES/2024/a.pdf"]
    assert (a.mall_folder, a.recibos_subgroup, a.recibos_year_folder, a.recibos_year) == \
        ("mallA", "LOCALES", "2024", 2024)
    g = idx["mallA/7. Recibos CFE/LOCALES/1985-2024/2021/g.pdf"]
    assert (g.recibos_year_folder, g.recibos_year) == ("2021", 2021)
    b = idx["mallA/7. Recibos CFE/b.PDF"]
    assert b.recibos_subgroup is None and b.file_name == "b.PDF"


def test_read_bills_csv_keeps_ids(spark, scratch):
    p = os.path.join(scratch, "bills.csv")
    with open(p, "w") as fh:
        fh.write(" no_servicio , kwh_total,tarifa\n000123,100,PDBT\n000456,,\n")
    df = read_bills_csv(spark, p)
    assert df.columns == ["no_servicio", "kwh_total", "tarifa"]
    rows = df.collect()
    assert rows[0].no_servicio == "000123" and rows[1].kwh_total is None


def test_progress_done_set(spark, scratch):
    p = os.path.join(scratch, "progress.jsonl")
    with open(p, "w") as fh:
        fh.write('{"file_path": "a", "status": "ok"}\n\n')
        fh.write('{"file_path": "a", "status": "error", "error": "x"}\n')
        fh.write('not json\n')
        fh.write('{"file_path": "b", "status": "error"}\n')
        fh.write('{"file_path": "", "status": "ok"}\n')
        fh.write('{"file_path": "c", "status": "ok"}\n')
    done = sorted(r.file_path for r in done_files(read_progress(spark, p)).collect())
    assert done == ["a", "c"]


def test_listing_rule_reads_a_path_once(spark):
    """The rule is one pattern, also as a filter; it agrees with the rule on segments."""
    def listed(path, root, folder):
        if path is None or not path.startswith(root + "/"):
            return False
        *dirs, name = path[len(root) + 1:].split("/")
        known = folder in root.split("/")
        inside = len(dirs) <= 1 or dirs[1] == folder if known else dirs[:1] == [folder] if len(dirs) == 1 else len(dirs) > 1 and dirs[1] == folder
        return name.lower().endswith(".pdf") and inside
    folder = "7. Recibos CFE"
    names = ["a.pdf", "a.PdF", ".pdf", "a.pdf\n", "a\nb.pdf", "a.xml", "pdf", ""]
    dirs = ["", "m/", f"{folder}/", f"m/{folder}/", f"/{folder}/", f"m/{folder}/x/y/", f"{folder}/{folder}/", f"{folder}/x/", f"m/x/{folder}/", "m/7x Recibos CFE/", "//"]
    for root in ("/bills", "/b.(ills", f"/r/{folder}"):
        paths = [f"{r}/{d}{n}" for r in (root, "/bxills", "") for d in dirs for n in names] + [None, root, "\n" + root + "/a.pdf"]
        df = spark.createDataFrame([(p,) for p in paths], "file_path string")
        found = [r.ok for r in df.select(path_predicate(F.col("file_path"), root, folder).alias("ok")).collect()]
        assert found == [listed(p, root, folder) for p in paths]
        assert "split(" not in read_listing(df, root, folder)._jdf.queryExecution().optimizedPlan().toString()


def test_listing_renders_a_path_once(spark):
    plan = render_bills(spark, "/root/testdata/sf0.001").listing._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("/Otros/") == 1


def test_year_folder_is_one_pattern(spark):
    """The first folder below the bills folder whose first year lies in the window; as on segments, without array functions."""
    folder, root = "7. Recibos CFE", "/bi.lls"

    def expected(path):
        if path is None or not path.startswith(root + "/"):
            return None, None
        parts = path[len(root) + 1:].split("/")
        below = parts[parts.index(folder) + 1:-1] if folder in parts else []
        for seg in below:
            found = re.search("(19|20)[0-9]{2}", seg)
            if found and 1990 <= int(found[0]) <= 2035:
                return seg, int(found[0])
        return None, None
    segments = ["2021", "1985-2024", "1989", "1990", "2035", "2036", "x 2019 y", "12021", "1920 2020", "a\n2022\nb", "2٠21", "", folder, "19 99", "191999", "2192005"]
    paths = [f"{root}/{m}{folder}/{a}/{b}/{leaf}" for m in ("", "m/", "2001/", f"{folder}/", "a/b/") for a in segments for b in segments
             for leaf in ("f.pdf", "2020")]
    paths += [f"{root}/{folder}/2020", f"{root}/m/{folder}", f"{root}/2020/x.pdf", f"/other/{folder}/2020/x", f"/bixlls/{folder}/2020/x", "", None, f"{root}/{folder}/2020/"]
    df = spark.createDataFrame([(p,) for p in paths], "file_path string")
    found = df.select(*path_metadata(F.col("file_path"), root, folder))
    assert [(r.recibos_year_folder, r.recibos_year) for r in found.collect()] == [expected(p) for p in paths]
    assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()
