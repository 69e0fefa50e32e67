"""Plain text and words of documents."""

from __future__ import annotations

import html
import re
import unicodedata

#: Tags and declarations of any length; a "<" that none closes before the next one is text.
_TAG = re.compile(r"</?[A-Za-z][^<>]*+>|<![^<>]*+>")
#: Soft hyphen, zero-width and direction marks, byte order mark, and combining marks.
_DROP = re.compile("[­͏؜​-‏‪-‮⁠-⁤﻿̀-ͯ᪰-᫿᷀-᷿⃐-⃿]+")
_WORD = re.compile(r"[^\W_]+|(?<!\w)_{3,}(?!\w)")
_MOJIBAKE = re.compile("[Â-ô][\u0080-¿ŒœŠšŸŽžƒˆ˜–-•…‰‹›€™]")
BLANK = "___"


def untagged(text: str, blank: str = " ") -> str:
    """Text without comments and tags, each replaced by ``blank``, in time linear in its length."""
    kept, at = [], 0
    while (start := text.find("<!--", at)) >= 0 and (end := text.find("-->", start + 4)) >= 0:
        kept.append(text[at:start])
        at = end + 3
    return _TAG.sub(blank, blank.join([*kept, text[at:]]))


def repair(text: str) -> str:
    """Undoes UTF-8 that was read as Windows-1252 or Latin-1, where the whole text allows it."""
    if _MOJIBAKE.search(text):
        for code in ("cp1252", "latin-1"):
            try:
                return text.encode(code).decode("utf-8")
            except UnicodeError:
                continue
    return text


def plain(text: str) -> str:
    """Markup and entities resolved, compatibility forms unified, accents and invisible characters gone, case folded."""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = untagged(text)
    if not text.isascii():
        text = _DROP.sub("", unicodedata.normalize("NFKD", repair(text)))
    return text.casefold()


def words(text: str) -> list[str]:
    """Folded words; a run of three or more underscores is a word of its own (a gap to fill)."""
    return _WORD.findall(plain(text))
