"""Text expressions: plain Column in, plain Column out, all evaluated in the JVM."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Personal-data patterns for detection, in order of precedence.
PII_PATTERNS = {
    "cpf": r"\d{3}\.\d{3}\.\d{3}-\d{2}",
    "cnpj": r"\d{2}\.\d{3}\.\d{3}/\d{4}-\d{2}",
    "phone": r"(\+\d{1,3})?\s?\(?\d{2}\)?\s?\d{4,5}-?\d{4}",
    "email": r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}",
    "patient_name": r"(?i)(paciente|patient|Sr\.|Dra?\.|Mrs?\.)\s+[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*",
}

# Personal-data patterns for masking, in order of replacement.
MASK_PATTERNS = {
    "CPF": r"\d{3}\.\d{3}\.\d{3}-\d{2}",
    "CNPJ": r"\d{2}\.\d{3}\.\d{3}/\d{4}-\d{2}",
    "PHONE": r"\(\d{2}\)\s?\d{4,5}-\d{4}",
    "EMAIL": r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}",
}

# Optional stricter variant: only the title ignores case, the name needs capitals.
STRICT_NAME_PATTERN = (
    r"(?:(?i:paciente|patient|Sr\.|Dra?\.|Mrs?\.))\s+[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*"
)

# Optional extra masking rule for calendar dates.
DATE_MASK = {"DATA": r"\b\d{1,2}/\d{1,2}/\d{4}\b|\b\d{4}-\d{2}-\d{2}\b"}

# Phrases that mark an answer as a refusal.
REFUSAL_PHRASES = (
    "não tenho acesso",
    "não posso responder",
    "desculpe",
    "não encontrei",
    "não foi possível",
    "não consegui",
    "sem acesso",
    "indisponível",
)

# Words that end a session and are not questions.
SESSION_WORDS = ("sair", "exit", "quit", "q")

MIN_QUESTION_CHARS = 5
MAX_QUESTION_CHARS = 500
CACHE_KEY_PREFIX = "medical_response:"

# Java needs (?U) for Unicode classes, and even then leaves out four separators.
_SPACE = r"[\s\x1c-\x1f]"


def _unicode(pattern: str) -> str:
    return "(?U)" + pattern


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends."""
    return F.regexp_replace(text, _unicode(rf"\A{_SPACE}+|{_SPACE}+\z"), "")


def is_blank(text: Column) -> Column:
    """True for NULL, empty and white-space-only text."""
    return F.coalesce(text, F.lit("")).rlike(_unicode(rf"\A{_SPACE}*\z"))


def tokens(text: Column) -> Column:
    """White-space tokens in order, without empty ones."""
    return F.filter(F.split(text, _unicode(rf"{_SPACE}+")), lambda t: t != "")


def length_ok(
    text: Column, low: int = MIN_QUESTION_CHARS, high: int = MAX_QUESTION_CHARS
) -> Column:
    """Code points after stripping lie in ``[low, high]``."""
    return F.char_length(strip(text)).between(low, high)


def pii_flags(text: Column, patterns: Mapping[str, str] = PII_PATTERNS) -> dict[str, Column]:
    """One boolean per kind of personal data."""
    return {kind: text.rlike(_unicode(p)) for kind, p in patterns.items()}


def first_pii(text: Column, patterns: Mapping[str, str] = PII_PATTERNS) -> Column:
    """Name of the first kind that matches, else NULL."""
    return F.coalesce(*[F.when(hit, F.lit(kind)) for kind, hit in pii_flags(text, patterns).items()])


def mask_pii(text: Column, patterns: Mapping[str, str] = MASK_PATTERNS) -> Column:
    """Replace each match by its kind in brackets."""
    for kind, pattern in patterns.items():
        text = F.regexp_replace(text, _unicode(pattern), f"[{kind}]")
    return text


def mask_counts(text: Column, patterns: Mapping[str, str] = MASK_PATTERNS) -> dict[str, Column]:
    """How many times each masking rule matches."""
    return {
        kind: F.regexp_count(text, F.lit(_unicode(p))).cast("bigint") for kind, p in patterns.items()
    }


def reply_is_yes(reply: Column) -> Column:
    """A reply counts as yes wherever it holds "sim" or "yes"."""
    low = F.lower(strip(reply))
    return low.contains("sim") | low.contains("yes")


def is_refusal(answer: Column) -> Column:
    low = F.lower(answer)
    hit = F.lit(False)
    for phrase in REFUSAL_PHRASES:
        hit = hit | low.contains(phrase)
    return hit


def is_session_word(text: Column) -> Column:
    return F.lower(strip(text)).isin(*SESSION_WORDS)


def question_tokens(question: Column) -> Column:
    return F.array_distinct(tokens(F.lower(question)))


def share_of_tokens(asked: Column, document: Column) -> Column:
    """Share of the given distinct tokens found in the document."""
    shared = F.array_intersect(asked, tokens(F.lower(document)))
    return F.size(shared) / F.greatest(F.size(asked), F.lit(1))


def token_overlap(question: Column, document: Column) -> Column:
    """Share of the distinct lower-case question tokens found in the document."""
    return share_of_tokens(question_tokens(question), document)


def cache_key(question: Column) -> Column:
    return F.concat(F.lit(CACHE_KEY_PREFIX), F.md5(F.lower(question).cast("binary")))


def cache_value(documents: Column, generation: Column) -> Column:
    return F.to_json(F.struct(documents.alias("documents"), generation.alias("generation")))


CACHE_VALUE_SCHEMA = "documents ARRAY<STRING>, generation STRING"


def parse_cache_value(value: Column) -> Column:
    return F.from_json(value, CACHE_VALUE_SCHEMA)


def qa_text(focus: Column, question: Column, answer: Column, url: Column) -> Column:
    """Text of one question-and-answer pair as it is indexed."""
    return F.concat(
        F.lit("Topic: "), focus, F.lit("\nQuestion: "), question,
        F.lit("\nAnswer: "), answer, F.lit("\nSource URL: "), url,
    )


def answer_or_pointer(answer: Column, url: Column) -> Column:
    """A blank answer is replaced by a pointer to the source."""
    pointer = F.concat(F.lit("Conteúdo protegido por copyright. Consulte a fonte oficial: "), url)
    return F.when(is_blank(answer), pointer).otherwise(answer)


def abstract_text(context: Column, question: Column, answer: Column) -> Column:
    """Text of one abstract record as it is indexed."""
    return F.concat(
        F.lit("Context: "), context, F.lit("\nQuestion: "), question,
        F.lit("\nExpert Answer: "), answer,
    )
