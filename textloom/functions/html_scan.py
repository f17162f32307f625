"""HTML to text by a state machine over one page.

Follows the states of a browser's tokenizer as far as text depends on them: quoted
attribute values may hold ``>``, comments end at ``-->`` or ``--!>``, the content of
raw text elements ends only at their own end tag, what is not closed reaches to the
end, and references are read by the browser rules, with or without a semicolon.
"""

from __future__ import annotations

import html
import re

# Elements without text of their own for a reader; their content is not markup.
HIDDEN = ("script", "style", "title", "template", "iframe", "noembed", "noframes")
# Elements whose content is text but not markup.
PLAIN = ("textarea", "xmp")
BLOCKS = frozenset("p div li h1 h2 h3 h4 h5 h6 br tr article nav footer ul".split())
# What may stand in the head without ending it.
HEAD = frozenset("head base basefont bgsound link meta noscript script style template title".split())

# After "<": a comment, another declaration, or a tag.  Possessive throughout, so nothing is read twice.
_COMMENT = re.compile(r"<!--(?:-?>|(?s:.*?)(?:--!?>|\Z))")
_DECLARED = re.compile(r"<(?:[!?]|/(?![a-zA-Z]))[^>]*+(?:>|\Z)")
_TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*+)(?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+)?)*+(>|\Z)""")
_OPEN = re.compile(r"<(?=[a-zA-Z/!?])")
_REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]{1,31};?)")
_IN_SCRIPT = re.compile(r"<!--|-->|<(/?)script(?=[\s/>])", re.IGNORECASE)
_END = {name: re.compile(rf"</{name}(?=[\s/>])(?:[^>]*+)(?:>|\Z)", re.IGNORECASE) for name in (*HIDDEN, *PLAIN)}


def _character(m: re.Match) -> str:
    ref = m[0]
    if ref[1] != "#":
        # A named blank counts as white space.
        return " " + ref[6:] if ref.startswith("&nbsp;") else " " + ref[5:] if ref.startswith("&nbsp") else html.unescape(ref)
    digits = ref[2:].rstrip(";")
    code = int(digits[1:], 16) if digits[0] in "xX" else int(digits) if len(digits) < 20 else 1 << 30
    if 0x80 <= code < 0xA0:
        # These numbers mean windows-1252.
        return bytes([code]).decode("cp1252", "ignore") or chr(code)
    return "�" if code == 0 or code > 0x10FFFF or 0xD800 <= code < 0xE000 else chr(code)


def references(text: str) -> str:
    """Character references in one pass, so that what they make is never taken for another."""
    return _REFERENCE.sub(_character, text) if "&" in text else text


def _raw_end(page: str, at: int, name: str) -> tuple[int, int]:
    """Where the content of a raw text element and its end tag stop; a page may end within."""
    end = _END[name].search(page, at)
    if end is None:
        return len(page), len(page)
    if name == "script" and page.find("<!--", at, end.start()) >= 0:
        # Within "<!--", a script in the script has an end tag of its own.
        escaped, double = False, False
        for m in _IN_SCRIPT.finditer(page, at):
            if m[0] == "<!--":
                escaped = True
            elif m[0] == "-->":
                escaped = double = False
            elif m[1] and not double:
                return m.start(), _END[name].match(page, m.start()).end()
            elif m[1]:
                double = False
            elif escaped:
                double = True
        return len(page), len(page)
    return end.start(), end.end()


def page_text(page: str) -> str:
    """Text of a page, a line feed for every block tag; white space is left as it is."""
    out: list[str] = []
    at, in_head = 0, False
    while at < len(page):
        m = _OPEN.search(page, at)
        stop = m.start() if m else len(page)
        if stop > at:
            if in_head and not page[at:stop].isspace():
                in_head = False
            out.append(references(page[at:stop]))
            at = stop
            continue
        if page.startswith("<!--", at):
            at = _COMMENT.match(page, at).end()
            continue
        tag = _TAG.match(page, at)
        if tag is None:
            at = _DECLARED.match(page, at).end()
            continue
        name, closing = tag[1].lower(), page[at + 1] == "/"
        at = tag.end()
        if not tag[2]:
            break
        if name == "head":
            in_head = not closing
        elif in_head and not closing and name not in HEAD:
            in_head = False
        if name in BLOCKS:
            out.append("\n")
        elif not closing and name in _END:
            content, end = _raw_end(page, at, name)
            if name in PLAIN:
                out.append(references(page[at:content]) if name == "textarea" else page[at:content])
            at = end
    return "".join(out)
