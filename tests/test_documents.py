import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from pagewell.plans.corpus import manifest_loader
from pagewell.sources import documents as docs

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_landing_check(spark, tmp_path):
    files = {"good.pdf": b"%PDF-1.4\nbody", "page.pdf": b"<html></html>", "empty.pdf": b"", "three.pdf": b"%PD"}
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    good, bad = docs.split_landed(docs.read_landed_files(spark, str(tmp_path), "*.pdf"))
    assert [r.url.rsplit("/")[-1] for r in good.collect()] == ["good.pdf"]
    rejected = {r.url.rsplit("/")[-1]: r.reason for r in bad.collect()}
    assert set(rejected) == {"page.pdf", "three.pdf"}  # an empty file is not listed
    assert all(reason.startswith("not a valid PDF: ") for reason in rejected.values())


def test_matching_papers(spark):
    papers = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, pdf_url string")
    files = spark.createDataFrame(
        [("a", bytearray(b"%PDF")), ("b", bytearray(b"<html>")), ("x", bytearray(b"%PDF"))],
        "url string, content binary",
    )
    good, bad = docs.match_landed(papers, files)
    assert [r.document_id for r in good.collect()] == [1]
    assert sorted(map(tuple, bad.collect())) == [(2, "not a valid PDF: b"), (3, "not landed: c")]


def payloads(spark):
    rows = [(1, bytearray(b"%PDF\none\x0ctwo")), (2, bytearray(b"%PDF\nbroken")), (3, bytearray(b"%PDF\ngap"))]
    return spark.createDataFrame(rows, "document_id long, content binary")


def extractor(content):
    if b"broken" in content:
        raise ValueError("bad xref")
    if b"gap" in content:
        return ["a", None, "c"]
    return docs.form_feed_pages(content)


def test_page_numbers_and_failures(spark):
    got = docs.extract_pages(payloads(spark), extractor, group_chars=1)
    pages = sorted((r.document_id, r.page_number, r.text) for r in docs.readable_pages(got).collect())
    assert pages == [(1, 1, "one"), (1, 2, "two"), (3, 1, "a"), (3, 3, "c")]
    assert [tuple(r) for r in docs.unreadable_documents(got).collect()] == [(2, "unreadable: bad xref")]


def test_nested_form_agrees(spark):
    flat = docs.readable_pages(docs.extract_pages(payloads(spark), extractor))
    nested = docs.extract_documents(payloads(spark), extractor)
    opened = nested.where(F.col("reason").isNull()).select("document_id", F.inline("pages"))
    assert sorted(map(tuple, opened.collect())) == sorted(map(tuple, flat.collect()))
    assert nested.where(F.col("reason").isNotNull()).first().pages == []


def test_a_round_opens_its_own_files_once(spark, tmp_path):
    bodies = {"a": b"%PDF-1\none\ftwo", "b": b"<html>", "c": b"%PDF-1\nother", "d": b"%PDF-1\nlast"}
    for name, body in bodies.items():
        (tmp_path / f"{name}.bin").write_bytes(body)
    paths = {r.path.rsplit("/", 1)[1][0]: r.path for r in docs.landing_manifest(spark, str(tmp_path)).collect()}
    rows = [(f"http://x/{k}", p) for k, p in paths.items()] + [("http://x/again", paths["a"])]
    manifest = spark.createDataFrame(rows, "url string, path string")
    papers = spark.createDataFrame([(1, "http://x/a"), (2, "http://x/b"), (3, "http://x/none"), (4, "http://x/d")], "id long, pdf_url string")
    got = manifest_loader(lambda s: manifest)(papers)
    rows = {r.document_id: ([p.text for p in r.pages or []], r.reason) for r in got.collect()}
    assert rows == {
        1: (["one", "two"], None), 2: ([], "not a valid PDF: http://x/b"),
        3: ([], "not landed: http://x/none"), 4: (["last"], None),
    }
    wanted = manifest.where("url in ('http://x/a', 'http://x/b', 'http://x/d')")
    for size in (10_000, 1, 3):
        files = docs.read_manifest_files(wanted, size)
        opened = [f for f in files.inputFiles() if f.endswith(".bin")]
        assert sorted(f[-5] for f in opened) == ["a", "b", "d"]
        assert {r.url[-1]: bytes(r.content) for r in files.collect()} == {k: bodies[k] for k in "abd"}
    assert docs.read_manifest_files(manifest.limit(0)).collect() == []
