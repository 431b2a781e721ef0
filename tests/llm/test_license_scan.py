import random
import re

from pyspark.sql import functions as F

from glyphmill.llm import license_scan


def words(text):
    return re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", (text or "").lower())


def shingles(text):
    own = words(text)
    return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set()


RANDOM = random.Random(6)
FILL = ["the", "of", "license", "under", "version", "work", "free", "software", "and", "x1", "é"]


def filler(n):
    return " ".join(RANDOM.choice(FILL) for _ in range(n))


def test_whole_and_damaged_notices_are_found(make_docs):
    rows, wanted = [], {}
    for i, (name, notice) in enumerate(license_scan.NOTICES * 4):
        own = notice.split()
        if len(own) > 40 and i >= len(license_scan.NOTICES):
            own[len(own) // 2] = "changed"
        rows.append((i, f"{filler(RANDOM.randint(0, 300))}\n{' '.join(own).upper()}. {filler(RANDOM.randint(0, 300))}"))
        wanted[i] = name
    rows += [(500, None), (501, ""), (502, filler(4000)), (503, "MIT"), (None, "Released under the MIT license!")]
    docs = make_docs(rows + rows[:1]).withColumn("Licenses", F.lit(0))
    found = license_scan.scan_licenses(docs)
    assert "Licenses" not in found.columns and found.count() == len(rows) + 1
    for row in found.collect():
        have = shingles(row["text"])
        for match in row["licenses"]:
            notice = dict(license_scan.NOTICES)[match["template_id"]]
            assert len(shingles(notice) & have) / len(shingles(notice)) >= match["containment"] - 1e-9 >= 0.8 - 1e-9
            spans = [row["text"].encode()[s["start"] : s["end"]].decode() for s in match["spans"]]
            assert any(len(shingles(notice) & shingles(s)) / len(shingles(notice)) >= 0.8 for s in spans)
        names = {m["template_id"] for m in row["licenses"]}
        if row["doc_id"] in wanted:
            assert wanted[row["doc_id"]] in names
        elif row["doc_id"] in (500, 501, 502, 503):
            assert not names
        else:
            assert names == {"mit"}


def test_contained_share_decides(make_docs):
    template = " ".join(f"w{i}" for i in range(104))
    own = template.split()
    rows = []
    for n in (4, 5, 19, 20, 21, 40):
        rows.append((n, filler(77) + " " + " ".join(own[: 104 - n]) + " " + filler(50)))
    found = license_scan.scan_licenses(make_docs(rows), [("t", template)]).collect()
    assert {r["doc_id"]: bool(r["licenses"]) for r in found} == {4: True, 5: True, 19: True, 20: True, 21: False, 40: False}


def test_no_templates_and_no_rows(make_docs):
    assert license_scan.scan_licenses(make_docs(["a b c d e"]), []).first()["licenses"] == []
    assert license_scan.scan_licenses(make_docs(["a b"]), [("none", " ..."), ("two", "A b")]).first()["licenses"][0]["template_id"] == "two"
    assert license_scan.scan_licenses(make_docs([])).count() == 0
