from tallystream.functions.envelope import (
    FAULTS,
    decode_topic,
    judge_envelope,
    parse_envelope,
    to_envelope,
)
from tallystream.functions.numbers import drop_unparsed, locale_float, locale_numbers, to_int
from tallystream.functions.text import clean_strings, clean_text, register_clean_functions

__all__ = [
    "FAULTS",
    "clean_strings",
    "clean_text",
    "decode_topic",
    "drop_unparsed",
    "judge_envelope",
    "locale_float",
    "locale_numbers",
    "parse_envelope",
    "register_clean_functions",
    "to_envelope",
    "to_int",
]
