"""Tables of prompts that still wait for a hosted model, and the parsing of its replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaero.functions import text as tx
from quaero.operators.translation import direction, text_key

# The relevance question.
RELEVANCE_START = (
    'Analise a seguinte pergunta e responda APENAS com "sim" ou "não".\n\n'
    "A pergunta é sobre medicina, saúde, doenças, tratamentos, protocolos médicos, \n"
    "diagnósticos, sintomas, medicamentos, cirurgias, ou tópicos clínicos similares?\n\n"
    'Pergunta: "'
)
RELEVANCE_END = '"\n\nResponda APENAS com "sim" ou "não":'

# The translation requests, by direction.
TRANSLATION_START = {
    "pt_en": (
        "Translate the following medical question from Portuguese to English. \n"
        "Maintain medical terminology accuracy. Return ONLY the translation, nothing else.\n\n"
        "Portuguese: "
    ),
    "en_pt": (
        "Translate the following medical response from English to Portuguese (Brazilian Portuguese - pt-BR).\n"
        "Maintain medical terminology accuracy and clarity. Return ONLY the translation, nothing else.\n\n"
        "English: "
    ),
}
TRANSLATION_END = {"pt_en": "\n\nEnglish:", "en_pt": "\n\nPortuguese (pt-BR):"}

REPLY_SCHEMA = "is_valid BOOLEAN, reason STRING, binary_score STRING"


def relevance_queue(questions: DataFrame, replies: DataFrame | None = None) -> DataFrame:
    """``(question, prompt)`` for each distinct question that needs a reply and has none.

    The cheap checks come first: what fails on length or personal data never
    reaches a model.
    """
    q = F.col("question")
    open_questions = questions.where(tx.length_ok(q) & tx.first_pii(q).isNull()).select("question").distinct()
    if replies is not None:
        open_questions = open_questions.join(replies.select("question"), "question", "left_anti")
    return open_questions.withColumn("prompt", F.concat(F.lit(RELEVANCE_START), q, F.lit(RELEVANCE_END)))


def translation_queue(
    df: DataFrame, translations: DataFrame, text: str = "text",
    source: Column | str = "language", target: Column | str = "target",
) -> DataFrame:
    """``(text_key, direction, prompt)`` for each distinct text without a translation."""
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    wanted = (
        df.select(F.col(text).alias("text"), direction(F.col(text), as_col(source), as_col(target)).alias("direction"))
        .where(F.col("direction").isNotNull())
        .distinct()
        .withColumn("text_key", text_key(F.col("text")))
        .join(translations.select("text_key", "direction"), ["text_key", "direction"], "left_anti")
    )
    start, end = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name in TRANSLATION_START:
        start = F.when(F.col("direction") == name, TRANSLATION_START[name]).otherwise(start)
        end = F.when(F.col("direction") == name, TRANSLATION_END[name]).otherwise(end)
    return wanted.select("text_key", "direction", F.concat(start, F.col("text"), end).alias("prompt"))


def structured_reply(json: Column) -> Column:
    """A JSON reply as ``(is_valid, reason, binary_score)``; fields it lacks are NULL."""
    return F.from_json(json, REPLY_SCHEMA)


def score_is_yes(binary_score: Column) -> Column:
    """A graded reply says ``sim`` or ``nao``."""
    return F.lower(tx.strip(binary_score)) == "sim"
