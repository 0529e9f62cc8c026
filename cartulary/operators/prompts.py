"""Prompts: output languages, personas, templates filled in a fixed order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartulary.functions.text import strip

# Names and codes of languages, values that mean the document's own, and a persona's required fields.
LANGUAGES = {
    "Korean": ("ko", "kor", "korean", "한국어", "국문"),
    "English": ("en", "eng", "english", "영어", "영문"),
    "Japanese": ("ja", "jp", "jpn", "japanese", "일본어"),
    "Chinese": ("zh", "zh-cn", "chinese", "중국어"),
    "Spanish": ("es", "spa", "spanish"),
    "French": ("fr", "fra", "french"),
    "German": ("de", "deu", "german"),
    "Vietnamese": ("vi", "vietnamese"),
}
AUTO = ("", "auto", "source", "same", "match", "detect", "자동")
PERSONA_FIELDS = ("label", "text_role", "artifact", "method", "image_role", "image_method")


def resolve_language(language: Column) -> Column:
    """`auto`, a known language's name, or the given name as it is."""
    given = strip(F.coalesce(language, F.lit("")))
    key = F.lower(given)
    names = F.create_map(*[F.lit(x) for name, aliases in LANGUAGES.items() for a in aliases for x in (a, name)])
    return F.when(key.isin(*AUTO), "auto").otherwise(F.coalesce(F.try_element_at(names, key), given))


def language_directive(language: Column, *, same: str = "the SAME language as the source document/context above (automatically detect the document's language and mirror it exactly)") -> Column:
    """what follows `write in`."""
    name = resolve_language(language)
    return F.when(name == "auto", F.lit(same)).otherwise(name)


def filled(template: Column | str, values: Mapping[str, Column | str]) -> Column:
    """a template with its {names} replaced one after another, in the order of values: what an earlier value brings
    in is replaced by the later ones, and never the other way."""
    out = F.lit(template) if isinstance(template, str) else template
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value if isinstance(value, Column) else F.lit(value), F.lit("")))
    return out


def persona_of(name: Column, personas: Mapping[str, Mapping[str, str]], default: str, field: str) -> Column:
    """A persona's field by its key, the default's where none is given; an unknown key is an error. A ledger without its
    fields or its default is one, too."""
    for key, spec in personas.items():
        if missing := [f for f in PERSONA_FIELDS if not spec.get(f)]:
            raise ValueError(f"persona {key} lacks {missing}")
    if default not in personas:
        raise ValueError(f"the default persona {default} isn't defined")
    key = F.lower(strip(F.coalesce(F.nullif(name, F.lit("")), F.lit(default))))
    table = F.create_map(*[F.lit(x) for k, spec in personas.items() for x in (k.lower(), spec[field])])
    return F.coalesce(F.try_element_at(table, key), F.raise_error(F.concat(F.lit("unknown persona "), key)))


def text_prompt(template: str, *, context: Column, domain: Column, num_questions: Column, role: Column, artifact: Column, label: Column, method: Column, language: Column) -> Column:
    """the prompt for text, from a template of the caller's own; role and method may name the {domain}."""
    in_domain = lambda x: filled(x, {"domain": domain})
    return filled(template, {"context": context, "persona_role": in_domain(role), "artifact": artifact, "persona_label": label, "persona_method": in_domain(method), "num_questions": num_questions, "language_directive": language_directive(language)})


def instruction_prompt(template: str, instruction: Column, given: Column, response: Column, *, end: str) -> Column:
    """A training text: the template's three places (%s) filled, then the end mark."""
    return F.concat(F.format_string(template, F.coalesce(instruction, F.lit("")), F.coalesce(given, F.lit("")), F.coalesce(response, F.lit(""))), F.lit(end))
