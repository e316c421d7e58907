from collections import Counter

from lumbung.llm import lines

from .fixtures import documents, words


def brute(rows, ratio=lines.RATIO, least=lines.SHARE_PAGES):
    total, seen = Counter(r[3] for r in rows), Counter()
    for _, text, _, source in rows:
        for line in {x.strip(" \t\r") for x in (text or "").split("\n")} - {""} if text is not None else ():
            seen[source, line] += 1
    often = {k for k, n in seen.items() if n >= least and n > ratio * total[k[0]]}
    return [None if t is None else "\n".join(x for x in t.split("\n") if (s, x.strip(" \t\r")) not in often) for _, t, _, s in rows]


def test_against_brute_force(spark):
    rows = []
    for i in range(300):
        text = [words(8, i), "cookie notice" if i % 3 else " cookie notice\t", words(5, i % 40), "" if i % 4 else "rare on b"]
        rows.append((i, "\n".join(text) if i % 17 else None, "en", ["a", "b", None][i % 3]))
    rows += [(900 + i, "cookie notice", "en", "few") for i in range(5)]
    found = {r["doc_id"]: r["text"] for r in lines.drop_lines(documents(spark, rows), least=10).collect()}
    assert [found[r[0]] for r in rows] == brute(rows, least=10)
    assert sum("cookie notice" in (t or "") for t in found.values()) == 5
    found = {r["doc_id"]: r["text"] for r in lines.drop_lines(documents(spark, rows)).collect()}
    assert [found[r[0]] for r in rows] == brute(rows) and not any("cookie notice" in (t or "") for t in found.values())


def test_edges(spark):
    docs = documents(spark)
    rows = lines.drop_lines(docs).collect()
    assert len(rows) == 13 and set(docs.columns) < set(rows[0].asDict())
    by = {r["doc_id"]: r for r in rows}
    assert by[4]["text"] is None and by[4]["n_lines"] == 0 and by[5]["text"] == "" and by[5]["n_lines"] == 1
    assert lines.drop_lines(documents(spark, [])).collect() == []


def test_a_page_may_lose_all(spark):
    rows = [(i, "menu\nfooter", "en", "a") for i in range(20)]
    found = lines.drop_lines(documents(spark, rows)).collect()
    assert len(found) == 20 and all(r["text"] == "" and r["n_dropped"] == 2 for r in found)


def test_shuffled_in_parts(spark, monkeypatch):
    rows = [(i, "\n".join([words(4, i), "footer", f"menu {i % 7}"]), "en", ["hot", "hot", None, "b"][i % 4]) for i in range(200)]
    docs = documents(spark, rows)
    expected = {r["doc_id"]: r["text"] for r in lines.drop_lines(docs).collect()}
    monkeypatch.setattr(lines, "BROADCAST_LINES", 0)
    monkeypatch.setattr(lines, "PART_PAGES", 9)
    found = lines.drop_lines(docs).collect()
    assert {r["doc_id"]: r["text"] for r in found} == expected and len(found) == 200 and [expected[r[0]] for r in rows] == brute(rows)


def test_clashing_names(spark):
    docs = documents(spark, [(i, f"{words(4, i)}\nfooter", "en", "a") for i in range(5)]).withColumnRenamed("key", "n_lines").withColumnRenamed("bucket", "__host2")
    found = lines.drop_lines(docs)
    assert sorted(found.columns) == sorted({*docs.columns, "n_lines", "n_dropped"}) and {r["n_lines"] for r in found.collect()} == {2}
