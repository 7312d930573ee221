import pytest
from pyspark.sql import functions as F

from quaero.functions import language as lang
from quaero.functions import text as tx
from quaero.operators import screening as sc
from quaero.operators import translation as tr


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"t {kind}").select(expr(F.col("t"))).first()[0]


@pytest.mark.parametrize("raw, clean", [
    ("  a b \n", "a b"), (" x ", "x"), ("\x1cq\x1f", "q"), ("", ""), ("　\u0085", ""),
])
def test_strip_matches_python(spark, raw, clean):
    assert raw.strip() == clean
    assert one(spark, raw, tx.strip) == clean


@pytest.mark.parametrize("raw", ["a  b", " a b ", "", "\n", "x\x1dy", "um  dois\ttrês"])
def test_tokens_match_python_split(spark, raw):
    assert one(spark, raw, tx.tokens) == raw.split()


@pytest.mark.parametrize("n, ok", [(4, False), (5, True), (500, True), (501, False)])
def test_length_gate_counts_code_points(spark, n, ok):
    assert one(spark, "  " + "é" * n + " ", tx.length_ok) is ok
    assert one(spark, "😀" * n, tx.length_ok) is ok


@pytest.mark.parametrize("text, kind", [
    ("cpf 123.456.789-09", "cpf"),
    ("cnpj 12.345.678/0001-95", "cnpj"),
    ("ligue (11) 98765-4321", "phone"),
    ("fone +55 11 987654321", "phone"),
    ("1234567890123456", "phone"),
    ("mail ana@example.org", "email"),
    ("o paciente João", None),
    ("paciente Maria Silva tosse", "patient_name"),
    ("paciente idoso com febre", "patient_name"),
    ("Dra. Ana", "patient_name"),
    ("mail ana@example.org cpf 123.456.789-09", "cpf"),
    ("qual o tratamento da sepse?", None),
])
def test_first_pii(spark, text, kind):
    import re

    expected = next((k for k, p in tx.PII_PATTERNS.items() if re.search(p, text)), None)
    assert one(spark, text, tx.first_pii) == expected
    if kind is not None:
        assert expected == kind


def test_strict_names_need_capitals(spark):
    strict = {**tx.PII_PATTERNS, "patient_name": tx.STRICT_NAME_PATTERN}
    assert one(spark, "paciente idoso com febre", lambda c: tx.first_pii(c, strict)) is None
    assert one(spark, "PACIENTE Maria", lambda c: tx.first_pii(c, strict)) == "patient_name"


def test_masking_and_counts(spark):
    text = "123.456.789-09 e 12.345.678/0001-95, (11) 98765-4321, 11987654321, a@b.co x@y.com"
    assert one(spark, text, tx.mask_pii) == "[CPF] e [CNPJ], [PHONE], 11987654321, [EMAIL] [EMAIL]"
    counts = tx.mask_counts(F.col("t"))
    row = spark.createDataFrame([(text,)], "t string").select(*[n.alias(k) for k, n in counts.items()]).first()
    assert row.asDict() == {"CPF": 1, "CNPJ": 1, "PHONE": 1, "EMAIL": 2}
    both = {**tx.MASK_PATTERNS, **tx.DATE_MASK}
    assert one(spark, "em 01/02/2024", lambda c: tx.mask_pii(c, both)) == "em [DATA]"


@pytest.mark.parametrize("reply, yes", [("Sim.", True), ("não", False), ("simples", True), (" YES ", True), ("", False)])
def test_reply(spark, reply, yes):
    assert one(spark, reply, tx.reply_is_yes) is yes


def test_screening_order_and_fail_open(spark):
    rows = [
        (1, "oi", "Sim"), (2, "mail ana@example.org", "Sim"), (3, "Qual é a receita de brigadeiro?", "não"),
        (4, "Qual é o protocolo de tratamento para IAM?", "Sim."), (5, "sem resposta do modelo", None), (6, None, None),
    ]
    df = spark.createDataFrame(rows, "id int, question string, reply string")
    got = {r.id: r for r in sc.screen(df, reply="reply").collect()}
    assert [got[i].is_safe for i in range(1, 7)] == [False, False, False, True, True, False]
    assert got[1].screening.reason == "Pergunta deve ter entre 5 e 500 caracteres"
    assert got[2].screening.has_pii and "(email)" in got[2].screening.reason
    assert not got[3].screening.is_medical_relevant and "Desculpe" in got[3].generation
    assert got[4].generation is None and got[4].screening.reason is None


def test_screening_error_text(spark):
    df = spark.createDataFrame([("uma pergunta", "falhou"), ("uma pergunta", None)], "question string, error string")
    got = sc.screen(df, error="error").orderBy(F.col("error").desc_nulls_last()).collect()
    assert got[0].generation == "Erro ao validar pergunta: falhou" and not got[0].is_safe
    assert got[1].is_safe


def test_clean_questions(spark):
    df = spark.createDataFrame([(" Sair ",), ("q",), ("  ",), (" febre? ",), ("quit now",)], "question string")
    assert sorted(r[0] for r in sc.clean_questions(df).collect()) == ["febre?", "quit now"]


def test_distinct_questions_are_judged_once(spark):
    df = spark.createDataFrame([(i, "same" if i else "other") for i in range(50)], "id int, question string")
    seen = []

    def judge(distinct):
        seen.append(distinct.count())
        return distinct.withColumn("n", F.char_length("question"))

    out = sc.once_per_distinct(df, ["question"], judge)
    assert seen == [2] and out.count() == 50 and out.where("n is null").isEmpty()


@pytest.mark.parametrize("text, primary, expected", [
    ("ab", "pt", "en"), (None, "pt", "en"), ("texto", "pt-BR", "pt"), ("text", "en-GB", "en"), ("texto", None, "en"),
    ("qual o tratamento", "es", "pt"), ("what is fever", "fr", "en"), ("diabetes", "fr", "en"), ("dor dor pain", "it", "pt"),
])
def test_language(spark, text, primary, expected):
    df = spark.createDataFrame([(text, primary)], "t string, p string")
    assert df.select(lang.identify_language(F.col("t"), F.col("p"))).first()[0] == expected


def test_translation_routes(spark):
    rows = [
        (1, "febre", "pt", "en"), (2, "fever", "en", "pt"), (3, "fever", "en", "en"), (4, "x", "pt", "en"),
        (5, "fièvre", "fr", "en"), (6, "tosse", "pt", "en"), (7, None, "pt", "en"),
    ]
    df = spark.createDataFrame(rows, "id int, text string, language string, target string")
    table = spark.createDataFrame([("febre", "pt_en", " fever \n"), ("fever", "en_pt", "febre")], "text string, direction string, translated string")
    table = table.select(tr.text_key(F.col("text")).alias("text_key"), "direction", "translated")
    got = {r.id: (r.direction, r.translated) for r in tr.route_translation(df, table).collect()}
    assert got == {
        1: ("pt_en", "fever"), 2: ("en_pt", "febre"), 3: (None, "fever"), 4: (None, "x"), 5: (None, "fièvre"),
        6: ("pt_en", "tosse"), 7: (None, None),
    }


def test_overlap(spark):
    df = spark.createDataFrame([("A a b c", "B c d"), ("", "x"), ("z", "")], "q string, d string")
    got = [r[0] for r in df.select(tx.token_overlap(F.col("q"), F.col("d"))).collect()]
    assert got == pytest.approx([2 / 3, 0.0, 0.0])


def test_cache_key_and_value_round_trip(spark):
    import hashlib

    assert one(spark, " Febre?", tx.cache_key) == "medical_response:" + hashlib.md5(b" febre?").hexdigest()
    df = spark.createDataFrame([(["a", "b"], "g")], "d array<string>, g string")
    back = df.select(tx.parse_cache_value(tx.cache_value(F.col("d"), F.col("g"))).alias("v")).first().v
    assert back.documents == ["a", "b"] and back.generation == "g"


def test_structured_replies(spark):
    from quaero.operators import queues as qs

    rows = [('{"is_valid": false, "reason": "fora"}',), ('{"binary_score": " Sim "}',), ("broken",)]
    df = spark.createDataFrame(rows, "j string").select(qs.structured_reply(F.col("j")).alias("r"))
    got = [(r.is_valid, r.reason, r.yes) for r in df.select("r.*", qs.score_is_yes(F.col("r.binary_score")).alias("yes")).collect()]
    assert got == [(False, "fora", None), (None, None, True), (None, None, None)]


def test_queues_leave_out_what_is_known(spark):
    from quaero.operators import queues as qs

    df = spark.createDataFrame([("qual febre?",), ("qual febre?",), ("mail a@b.co",), ("já respondida",), ("oi",)], "question string")
    known = spark.createDataFrame([("já respondida", "Sim")], "question string, reply string")
    row, = qs.relevance_queue(df, known).collect()
    assert row.question == "qual febre?" and 'Pergunta: "qual febre?"' in row.prompt
