"""Schemas of the stored relations, as DDL."""

from __future__ import annotations

from pyspark.sql import types as T

_AUDIT = "status string, reject_reason string, tier int, source string, model string, prompt_hash string"

RELATIONS = {
    "candidates": "headword string, pos string, tier int, cefr string, freq_rank int, is_multiword boolean, sources array<string>, pos_source string",
    "evidence": "headword string, pos string, kind string, source string, payload string",
    "unresolved": "headword string, raw_pos string, source string, reason string",
    "source_meta": "source string, title string, tier int, license string, attribution string, shippable boolean, url string",
    "counters": "name string, next_id bigint",
    "items": "item_id bigint, l2 string, headword string, pos string, stable_key string",
    "senses": "sense_id bigint, item_id bigint, sense_ordinal int, is_primary boolean",
    "universe_items": "item_id bigint, sense_id bigint, l2 string, headword string, pos string, cefr string, freq_rank int, stable_key string",
    "job_attempts": "run_id string, job string, key string, attempt int, status string, reason string, model string, prompt_hash string, from_cache boolean, at timestamp",
    "llm_cache": "prompt_hash string, model string, response string, at timestamp",
    "sense_cards": f"sense_id bigint, item_id bigint, stable_key string, gloss_en string, register string, usage_note string, {_AUDIT}",
    "sense_examples": "sense_id bigint, seq int, text string, tier int, source string",
    "item_phonetics": "item_id bigint, variant string, ipa string, source string",
    "item_level": "item_id bigint, cefr string, freq_rank int, source string",
    "sense_usage_note": f"sense_id bigint, note string, reason string, {_AUDIT}",
    "sense_gloss_l1": "sense_id bigint, l1 string, gloss string, tier int, source string, model string",
    "sense_gloss_l1_note": "sense_id bigint, l1 string, note string, tier int, source string, model string",
    "sense_translation": f"sense_id bigint, l1 string, definition string, usage_note string, {_AUDIT}",
    "sense_translation_examples": "sense_id bigint, l1 string, seq int, text string",
    "sense_cloze": f"sense_id bigint, stable_key string, warnings array<string>, {_AUDIT}",
    "sense_cloze_question": "sense_id bigint, seq int, difficulty string, sentence string, answer string, blank_start int, blank_end int",
    "sense_cloze_option": "sense_id bigint, seq int, opt_seq int, text string",
    "sense_cloze_translation": f"sense_id bigint, l1 string, {_AUDIT}",
    "sense_cloze_translation_sentence": "sense_id bigint, l1 string, seq int, text string",
    "sense_cloze_rationale": f"sense_id bigint, question_sha256 string, {_AUDIT}",
    "sense_cloze_hint": "sense_id bigint, seq int, hint string",
    "sense_cloze_option_reason": "sense_id bigint, seq int, opt_seq int, reason string",
    "sense_cloze_rationale_translation": f"sense_id bigint, l1 string, rationale_sha256 string, {_AUDIT}",
    "sentence_grammar": f"owner string, group_key string, source_sha256 string, {_AUDIT}",
    "sentence_grammar_rule": "owner string, group_key string, ref string, rank int, rule_id string, trigger string, note string",
    "sentence_grammar_translation": f"owner string, group_key string, l1 string, note_sha256 string, {_AUDIT}",
    "sentence_grammar_rule_l1": "owner string, ref string, rank int, l1 string, note string",
    "grammar_candidate": "owner string, ref string, seq int, proposed_name string, trigger string, rationale string",
    "grammar_catalog_translation": f"rule_id string, l1 string, catalog_sha256 string, {_AUDIT}",
    "grammar_rule_l1": "rule_id string, l1 string, name string, short string",
    "catalog": "rule_id string, name_en string, short_en string, level string, assume_known_from string, trivial boolean, merged_into string",
}


def schema(name: str) -> T.StructType:
    return T._parse_datatype_string(RELATIONS[name])
