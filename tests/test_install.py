"""The library as somebody uses it who has not set a path: their session is begun elsewhere, and workers find what they need."""

import os
import subprocess
import sys
import tomllib
from pathlib import Path

ROOT = Path(__file__).parents[1]
SCRIPT = '''
import sys
sys.path.insert(0, {root!r})  # as an installed package is on the driver's path
from pyspark.sql import SparkSession
spark = SparkSession.builder.master({master!r}).config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {shared!r}).config("spark.executor.memory", "1g").getOrCreate()
from lumbung.plans.articles import Context
from lumbung.plans.phases import Landed, full
context = Context(as_of="2026-11-26T12:00:00", years=(2025, 2026), topics={{"Flu": ["flu"]}}, places={{"Bali": ["bali"]}})
html = "<!--" + "x" * 200 + "--><h1>Flu di Bali</h1><article>isi</article><time>soon</time>"
sitemaps = spark.createDataFrame([("https://www.merdeka.com/sitemap.xml", "<urlset><url><loc>https://www.merdeka.com/sehat/2026/03/04/a</loc><lastmod>Rabu 4 Maret 2026, pukul 9</lastmod></url></urlset>")], "sitemap_url string, xml string")
pages = spark.createDataFrame([("https://www.merdeka.com/sehat/2026/03/04/a", 200, html)], "url string, status int, html string")
clean, bad = full(Landed(sitemaps=sitemaps, pages=pages), context, folder={folder!r})
print("ROWS", [(r["Title"], r["Penyakit"], r["Lokasi"], r["Year"]) for r in clean.collect()])
spark.stop()
'''


def run(tmp_path, master):
    script = tmp_path / "use.py"
    script.write_text(SCRIPT.format(root=str(ROOT), master=master, shared=f"file://{tmp_path}/shared", folder=f"file://{tmp_path}/run"))
    environment = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_SUBMIT_ARGS")}
    done = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=600, env=environment, cwd=tmp_path, check=False)
    return done.stdout + done.stderr


def test_the_example_in_a_process_without_a_path(tmp_path):
    assert "ROWS [('Flu di Bali', 'Flu', 'Bali', 2026)]" in run(tmp_path, "local[2]")


def test_project_file_names_the_package():
    project = tomllib.loads((ROOT / "pyproject.toml").read_text())
    assert project["project"]["name"] == "lumbung" and any(d.startswith("pyspark") for d in project["project"]["dependencies"])
