"""String patterns: shell globs as Java regular expressions."""

from __future__ import annotations

_SPECIAL = set(".^$+{}()|\\")


def glob_to_regex(glob: str) -> str:
    """Whole-string regular expression for a shell glob (``* ? [..] [!..]``)."""
    out, i = [], 0
    while i < len(glob):
        c = glob[i]
        if c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif c == "[" and "]" in glob[i + 2 :]:
            end = glob.index("]", i + 2)
            body = glob[i + 1 : end].replace("\\", "\\\\").replace("[", "\\[").replace("&&", "&\\&")
            out.append("[^" + body[1:] + "]" if body.startswith("!") else "[" + body + "]")
            i = end
        elif c in _SPECIAL or c in "[]":
            out.append("\\" + c)
        else:
            out.append(c)
        i += 1
    return "(?s)^" + "".join(out) + "$"
