"""Objective wording: the verbs an objective may use, states of mind it may not rest on, and verb forms of Persian words."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import word_forms

# Fixed values of the objective lexicon.
PERFORMANCE_VERBS = {
    "name": ("بگوید", "نام ببرد"),
    "identify": ("نشان دهد", "پیدا کند", "تشخیص دهد", "مشخص کند"),
    "describe": ("توضیح دهد", "شرح دهد"),
    "classify": ("دسته بندی کند", "گروه کند", "جدا کند"),
    "compare": ("مقایسه کند", "فرق را بگوید"),
    "perform": ("انجام دهد", "بسازد", "رعایت کند", "درست کند", "بکشد", "آزمایش کند"),
}
STATES_OF_MIND = (
    "بداند", "بدانند", "درک کند", "درک کنند", "بفهمد", "بفهمند", "آشنا شود", "آشنا شوند", "آگاه شود", "آگاه باشد",
    "یاد بگیرد", "یاد بگیرند", "متوجه شود", "پی ببرد", "پی ببرند", "علاقه مند شود", "احساس کند", "باور کند", "شناخت پیدا کند",
)
SCAFFOLDING = ("دانش آموز", "بتواند", "بتوانند")
#: Kinds of objective that suit a kind of concept.
SUITABLE = {
    "conceptual": ("name", "identify", "describe", "classify", "compare"), "procedural": ("perform", "describe"), "representational": ("identify", "describe", "name"),
    "language": ("name", "describe", "identify"), "meta": ("perform", "describe"),
}
#: Fixed word lists and pattern of verb forms.
VERB_STEMS = ("کرد", "کن", "شد", "شو", "بود", "باش", "هست", "نیست", "داشت", "دار", "داد", "ده", "گرفت", "گیر", "توان", "خواست", "خواه", "زد", "زن")
ENDINGS = ("م", "ی", "د", "یم", "ید", "ند")
VERB_FORM = rf"^ن?می|(?:[یاورنز]دن|[سفخش]تن)$|^[نب]?(?:{'|'.join(VERB_STEMS)})(?:{'|'.join(ENDINGS)})?$"


def is_verb_form(word: Column) -> Column:
    """An imperfective prefix, an infinitive's ending, or a common stem with a personal ending and at most a prefix."""
    return word.rlike(VERB_FORM)


def holds_phrase(text: Column, phrases: tuple[str, ...] | list[str]) -> Column:
    """Whether all words of one of the phrases are among the text's words, joiners read either way."""
    words = word_forms(text)
    return reduce(lambda a, b: a | b, [F.size(F.array_except(F.array(*map(F.lit, p.split())), words)) == 0 for p in phrases], F.lit(False))


def is_vague(statement: Column) -> Column:
    return holds_phrase(statement, STATES_OF_MIND)


def verb_is_observable(verb: Column) -> Column:
    known = [v for verbs in PERFORMANCE_VERBS.values() for v in verbs]
    return F.coalesce(holds_phrase(verb, known) & ~is_vague(verb), F.lit(False))


def type_fits(objective_type: Column, concept_type: Column) -> Column:
    """Concept types that the lexicon doesn't know suit every objective."""
    known = F.create_map(*[x for k, v in SUITABLE.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return F.coalesce(F.array_contains(F.element_at(known, concept_type), objective_type), F.lit(True))


def lexicon_words() -> list[str]:
    """Words that objectives bring along, whatever the lesson says."""
    phrases = [*(v for verbs in PERFORMANCE_VERBS.values() for v in verbs), *STATES_OF_MIND, *SCAFFOLDING]
    return sorted({w for p in phrases for w in p.split()})


def strip_lexicon(words: Column) -> Column:
    return F.array_except(words, F.array(*map(F.lit, lexicon_words())))
