"""Column expressions for timed words, clocks and payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters trimmed from a word, and the filler words.
CUTSET = ".,!?;:\"'"
FILLERS = ["um", "uh", "er", "ah", "like", "you know", "sort of", "kind of"]


def bare(word: Column) -> Column:
    return F.btrim(word, F.lit(CUTSET))


def is_filler(word: Column) -> Column:
    """Case and surrounding punctuation don't count. A filler of two words only matches one token that holds both."""
    return F.lower(bare(word)).isin(FILLERS)


def same_word_form(word: Column) -> Column:
    """What two words have in common when they count as the same."""
    return F.lower(F.btrim(bare(word)))


def diff_form(word: Column) -> Column:
    """Lower case without leading and trailing non-word characters, by Unicode's classes."""
    return F.regexp_replace(F.lower(word), r"(?U)^[\W_]+|[\W_]+$", "")


def not_blank(word: Column) -> Column:
    return F.btrim(word) != ""


def rounded(x: Column, digits: int = 3) -> Column:
    """Half away from zero, on the scaled double."""
    return F.round(x * 10**digits) / 10**digits


def rebased(offset: Column, stride: Column | float, start: Column | float) -> Column:
    """Frame offsets to seconds of the recording, to the millisecond."""
    return F.round(offset * stride + start, 3)


def clock(seconds: Column, mark: str = ",") -> Column:
    """HH:MM:SS and milliseconds, all truncated."""
    whole = seconds.cast("long")
    ms = ((seconds - whole) * 1000).cast("long")
    return F.format_string(f"%02d:%02d:%02d{mark}%03d", F.floor(seconds / 3600).cast("long"), F.floor(seconds / 60).cast("long") % 60, whole % 60, ms)


def joined(words: Column) -> Column:
    """The non-blank words of an array of structs with `word`, joined by a space."""
    return F.array_join(F.filter(F.transform(words, lambda w: w["word"]), not_blank), " ")


def up_to(words: Column) -> Column:
    """The latest end in an array of structs with `end_time`; 0 when it is empty."""
    return F.coalesce(F.array_max(F.transform(words, lambda w: w["end_time"])), F.lit(0.0))


def payload_seconds(size: Column, rate: Column | int, channels: Column | int) -> Column:
    """Seconds of 16-bit samples; 0 where rate or channels is 0."""
    frame = F.lit(rate) * F.lit(channels) * 2
    return F.when(frame > 0, size / frame).otherwise(0.0)
