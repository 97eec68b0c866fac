"""Prompts as expressions. Their texts are fixed values that model servers get verbatim."""

from __future__ import annotations

from loomline.functions.text import text_lit

TRANSLATOR_SYSTEM = "You are a professional translator."
TRANSLATOR_USER = (
    "Translate the following text from {source_lang} ({src_lang_code}) to {target_lang} ({tgt_lang_code}).\n"
    "- Preserve meaning, tone, and formatting.\n- Output only the translation, with no explanations.\n\nText:\n{text}"
)
JUDGE_SYSTEM = "You are a strict translation quality judge."
JUDGE_USER = (
    "Evaluate whether the candidate translation is acceptable.\n"
    "Return ONLY a JSON object with keys: pass (boolean), reason_code (string), notes (string).\n\n"
    "Source language: {source_lang}\nTarget language: {target_lang}\nSource text:\n{source_text}\n\nCandidate translation:\n{candidate_text}"
)
SCORER = "source: {source}\nhypothesis: {hypothesis}\nreference: {reference}\nscore:"


def filled(template: str, **columns: str) -> str:
    """SQL that puts columns into a template's places."""
    parts, rest = [], template
    while rest:
        at = min((rest.find("{" + name + "}") for name in columns if "{" + name + "}" in rest), default=-1)
        if at < 0:
            parts.append(text_lit(rest))
            break
        if at:
            parts.append(text_lit(rest[:at]))
        name = rest[at + 1 : rest.index("}", at)]
        parts.append(columns[name])
        rest = rest[at + len(name) + 2 :]
    return f"concat({', '.join(parts)})"


def messages(system: str, user: str) -> str:
    return f"array(named_struct('role', 'system', 'content', {text_lit(system)}), named_struct('role', 'user', 'content', {user}))"


def translation_messages(text: str, source: str, target: str) -> str:
    lang = {"source_lang": text_lit(source), "src_lang_code": text_lit(source), "target_lang": text_lit(target), "tgt_lang_code": text_lit(target)}
    return messages(TRANSLATOR_SYSTEM, filled(TRANSLATOR_USER, text=text, **lang))


def judge_messages(text: str, candidate: str, source: str, target: str) -> str:
    return messages(JUDGE_SYSTEM, filled(JUDGE_USER, source_lang=text_lit(source), target_lang=text_lit(target), source_text=text, candidate_text=candidate))


def scorer_prompt(source: str, hypothesis: str) -> str:
    return filled(SCORER, source=source, hypothesis=hypothesis, reference="''")
