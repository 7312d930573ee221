import pytest
from pyspark.sql import functions as F

from quaero.plans.answer import retrieve
from quaero.plans.ingest import build_collection, open_corpus
from quaero.sources import collection as store
from quaero.sources import corpus as src

PLACEHOLDER = "Conteúdo protegido por copyright. Consulte a fonte oficial: "


def test_qa_xml(spark, fixtures):
    files, broken = src.read_qa_xml(spark, f"{fixtures}/corpus/qa")
    assert [r.source for r in broken.collect()] == ["broken.xml"]
    pairs = {(r.source, r.qid): r for r in src.explode_qa(files).collect()}
    assert len(pairs) == 5
    first = pairs[("a01.xml", "a01-1")]
    assert (first.focus, first.qtype, first.semantic_group) == ("Tea Allergy", "information", "Disorders")
    assert first.cuis == ["X0000001", "X0000002"]
    assert pairs[("a01.xml", "a01-4")].original_id == "unknown"
    bare = pairs[("a02.xml", "a02-1")]
    assert (bare.focus, bare.url) == ("General Health", "URL não informada")


def test_qa_text_and_blank_answers(spark, fixtures):
    files, _ = src.read_qa_xml(spark, f"{fixtures}/corpus/qa")
    texts = {r.qid: r for r in src.qa_documents(src.explode_qa(files)).collect()}
    assert texts["a02-1"].page_content == (
        "Topic: General Health\nQuestion: Will it pass ?\nAnswer: Yes, after a nap.\nSource URL: URL não informada"
    )
    for qid in ("a01-2", "a01-3", "a01-4"):
        assert f"Answer: {PLACEHOLDER}http://example.org/tea.html\n" in texts[qid].page_content
    assert texts["a01-1"].type == "medquad_xml"


def test_white_space_in_answers_is_kept(spark, tmp_path):
    folder = tmp_path / "ws"
    folder.mkdir()
    (folder / "w.xml").write_text(
        '<Document id="w" url="u"><QAPairs><QAPair pid="1"><Question>  q ?</Question>'
        "<Answer>  two\n lines </Answer></QAPair></QAPairs></Document>"
    )
    files, _ = src.read_qa_xml(spark, str(folder))
    row = src.explode_qa(files).first()
    assert row.answer == "  two\n lines " and row.question == "  q ?"


def test_protocol_sections(spark, fixtures):
    sections, broken = src.read_protocol_xml(spark, f"{fixtures}/corpus/protocols")
    rows = sections.orderBy("section_no").collect()
    assert [r.section for r in rows] == ["Diagnosis", "Treatment"] and broken.isEmpty()
    assert rows[0].keywords == ["hiccup", "water", "breath"] and str(rows[0].last_updated) == "2024-05-06"
    document = src.protocol_documents(sections).where("page_content like '%Treatment%'").first()
    assert document.focus == "Breathing" and "Hold the breath" in document.page_content


def test_keyed_json(spark, fixtures):
    keyed, broken = src.read_keyed_json(spark, f"{fixtures}/corpus/json")
    assert [r.source for r in broken.collect()] == ["broken_pqal.json"]
    texts = {r.pubmed_id: r.page_content for r in src.abstract_documents(src.abstract_records(keyed)).collect()}
    assert texts == {
        "101": "Context: First part.\nSecond part.\nQuestion: Do naps help?\nExpert Answer: They do.",
        "102": "Context: One scalar context.\nQuestion: Is tea warm?\nExpert Answer: Mostly.",
        "103": "Context: \nQuestion: Anything else?\nExpert Answer: ",
    }


def test_labels(spark, fixtures):
    assert {tuple(r) for r in src.read_label_map(spark, f"{fixtures}/labels").collect()} == {("101", "yes"), ("102", "no"), ("103", "maybe")}
    rows = {r.id: r for r in src.read_labelled_set(spark, f"{fixtures}/labelled").collect()}
    assert rows["102"].reasoning_free_pred == "maybe" and rows["101"].final_decision == "yes"


def test_mixed_corpus(spark, fixtures):
    extra = spark.createDataFrame([("page text", "scan.pdf", "pdf")], "page_content string, source string, type string")
    documents, broken = src.load_corpus(spark, f"{fixtures}/corpus", extra)
    counts = {r.type: r["count"] for r in documents.groupBy("type").count().collect()}
    assert counts == {"medquad_xml": 5, "protocol_xml": 2, "pubmed_qa": 3, "pdf": 1}
    assert {r.source for r in broken.collect()} == {"broken.xml", "broken_pqal.json"}


def test_missing_root_is_empty(spark, tmp_path):
    documents, broken = src.load_corpus(spark, str(tmp_path / "nowhere"))
    assert documents.isEmpty() and broken.isEmpty()


def test_build_masks_before_chunking(spark, fixtures):
    documents, _ = src.load_corpus(spark, f"{fixtures}/corpus")
    chunks = build_collection(documents, size=60, overlap=10, dims=32)
    assert chunks.where("page_content like '%nurse@%'").isEmpty()
    assert not chunks.where("page_content like '%[EMAIL]%'").isEmpty()
    assert {len(r.embedding) for r in chunks.collect()} == {32}


def test_open_corpus_and_search_it(spark, fixtures, tmp_path):
    path = str(tmp_path / "corpus")
    chunks = open_corpus(spark, f"{fixtures}/corpus", path)
    assert chunks.select("corpus_id").distinct().count() == chunks.count() == 10
    asked = spark.createDataFrame([(1, "hold the breath for hiccup")], "question_id int, question string")
    top = retrieve(asked.withColumn("question_en", F.col("question")), chunks).first()
    assert top.documents[0].source == "p01.xml" and top.retrieved == 4


def test_collection_life_cycle(spark, tmp_path):
    path = str(tmp_path / "store")
    df = spark.createDataFrame([("a", 0, "x"), ("b", 0, "y")], "source string, chunk_no int, page_content string")
    built = []

    def build():
        built.append(1)
        return store.lay_out(df)

    assert store.open_or_build(spark, path, build).count() == 2
    assert store.open_or_build(spark, path, build).count() == 2 and built == [1]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        store.write_collection(df, path)
    current = store.open_collection(spark, path)
    renewed = store.reset_collection(current.withColumn("page_content", F.upper("page_content")), path)
    assert {r.page_content for r in renewed.collect()} == {"X", "Y"}
    assert current.count() == 2  # the old version is still readable
    assert store.find_source(renewed, "b").count() == 1
    with pytest.raises(FileNotFoundError):
        store.open_collection(spark, str(tmp_path / "none"))


def test_audit_log(spark, tmp_path):
    rows = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (2, "2024-01-02 10:00:00")], "question_id int, answered_at string")
    rows = rows.withColumn("answered_at", F.col("answered_at").cast("timestamp"))
    for _ in range(2):
        store.append_audit(rows, str(tmp_path / "audit"))
    back = spark.read.parquet(str(tmp_path / "audit"))
    assert back.count() == 4 and back.select("date").distinct().count() == 2


def test_quarantine_names_every_file(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "1.xml").write_text("<Document><QAPairs>", encoding="utf-8")
        (tmp_path / folder / "labels.json").write_text("[1, 2", encoding="utf-8")
    (tmp_path / "a" / "good.json").write_text('{"7": "yes"}', encoding="utf-8")
    _, broken = src.load_corpus(spark, str(tmp_path))
    assert sorted(r.path.split("/")[-2:] for r in broken.collect()) == [["a", "1.xml"], ["b", "1.xml"]]
    assert src.json_quarantine(spark, str(tmp_path)).count() == 2
    assert [tuple(r) for r in src.read_label_map(spark, str(tmp_path)).collect()] == [("7", "yes")]


def test_half_written_version_and_two_writers(spark, tmp_path):
    path = str(tmp_path / "store")
    df = spark.createDataFrame([("a", 0, "x")], "source string, chunk_no int, page_content string")
    df.write.parquet(f"{path}/version=dead")  # a build that died before its pointer
    assert store.open_or_build(spark, path, lambda: df).count() == 1
    store._write_version(df.unionAll(df), path)
    store._write_version(df.unionAll(df).unionAll(df), path)
    assert store.open_collection(spark, path).count() == 3
    assert store.expire_versions(spark, path, older_than_seconds=3600) == 0
    assert store.expire_versions(spark, path, older_than_seconds=-60) == 3
    assert store.open_collection(spark, path).count() == 3
