"""String functions: video ids, team-name canonicalisation, response fences.

All functions map Column -> Column and stay inside whole-stage codegen
(regexp_replace / translate / replace), so no Python worker is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import dims
from ..dims import Dictionaries

# Fixed value: the video-id pattern of the original ingest step (unanchored search).
VIDEO_ID_PATTERN = r"(?:v=|youtu\.be/)([A-Za-z0-9_-]{11})"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Fixed value: the characters that the original's ``strip()`` and ``\s`` take for white space.
WHITE_SPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
               "\u2028\u2029\u202f\u205f\u3000")
_SPACES = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]*"


def strip_ws(c) -> Column:
    """Python ``str.strip()``: white space of all of Unicode."""
    return F.btrim(_col(c), F.lit(WHITE_SPACE))


def parse_video_id(url) -> Column:
    """First 11-char id after ``v=`` or ``youtu.be/``; null when absent."""
    return F.nullif(F.regexp_extract(_col(url), VIDEO_ID_PATTERN, 1), F.lit(""))


def normalise_name(name, d: Dictionaries = dims.PRODUCTION) -> Column:
    """Team-name clean-up in the original order of steps.

    lower+trim -> accent fold -> keep [a-z0-9 ] -> word substitutions (longest
    key first, substring-wise) -> drop the words de/del -> collapse spaces ->
    strip one leading club prefix -> trim.
    """
    s = F.lower(strip_ws(name))
    s = F.translate(s, dims.ACCENT_FOLD_FROM, dims.ACCENT_FOLD_TO)
    s = F.regexp_replace(s, "[^a-z0-9 ]", "")
    for src, dst in d.substitutions_longest_first():
        s = F.replace(s, F.lit(src), F.lit(dst))
    s = F.regexp_replace(s, dims.STOP_WORDS_PATTERN, "")
    s = F.trim(F.regexp_replace(s, " +", " "))
    s = F.regexp_replace(s, dims.NAME_PREFIX_PATTERN, "")
    return F.trim(s)


def canonical_name(name, d: Dictionaries = dims.PRODUCTION) -> Column:
    """Alias lookup on the normalised name, defaulting to the name itself."""
    norm = normalise_name(name, d)
    if not d.aliases:
        return norm
    alias_map = F.create_map(*[F.lit(x) for kv in d.aliases.items() for x in kv])
    return F.coalesce(F.try_element_at(alias_map, norm), norm)


def strip_fence(raw) -> Column:
    """Drop a leading ```json / ``` fence and a trailing ``` fence."""
    s = strip_ws(raw)
    s = F.regexp_replace(s, r"^```(?:json)?" + _SPACES, "")
    return F.regexp_replace(s, _SPACES + r"```$", "")
