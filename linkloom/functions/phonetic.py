"""Metaphone after Philips's published rules of 1990."""

from __future__ import annotations

from functools import lru_cache

FRONT = set("EIY")
VOWELS = set("AEIOU")
SILENT_STARTS = ("AE", "GN", "KN", "PN", "WR")


@lru_cache(maxsize=100_000)
def metaphone(word: str) -> str:
    """Code of a word's sound; characters that are no letters are skipped."""
    w = "".join(ch for ch in word.upper() if "A" <= ch <= "Z")
    if w.startswith(SILENT_STARTS):
        w = w[1:]
    elif w.startswith("X"):
        w = "S" + w[1:]
    elif w.startswith("WH"):
        w = "W" + w[2:]
    out = []
    n = len(w)
    for i, ch in enumerate(w):
        before = w[i - 1] if i else ""
        after = w[i + 1] if i + 1 < n else ""
        two = w[i + 2] if i + 2 < n else ""
        if ch == before and ch != "C":
            continue
        if ch in VOWELS:
            if i == 0:
                out.append(ch)
        elif ch == "B":
            if not (before == "M" and not after):
                out.append("B")
        elif ch == "C":
            if after == "I" and two == "A" or after == "H" and before != "S":
                out.append("X")
            elif after in FRONT and after:
                if before != "S":
                    out.append("S")
            else:
                out.append("K")
        elif ch == "D":
            out.append("J" if after == "G" and two in FRONT and two else "T")
        elif ch == "G":
            if after == "H" and (not two or two not in VOWELS):
                if not two and not i:
                    out.append("K")
            elif after == "N" and (not two or w[i + 1 :] == "NED"):
                pass
            elif before == "D" and after in FRONT and after:
                pass
            else:
                out.append("J" if after in FRONT and after and before != "G" else "K")
        elif ch == "H":
            if after in VOWELS and after and before not in set("CSPTG"):
                out.append("H")
        elif ch == "K":
            if before != "C":
                out.append("K")
        elif ch == "P":
            out.append("F" if after == "H" else "P")
        elif ch == "Q":
            out.append("K")
        elif ch == "S":
            out.append("X" if after == "H" or after == "I" and two in {"O", "A"} else "S")
        elif ch == "T":
            if after == "I" and two in {"O", "A"}:
                out.append("X")
            elif after == "H":
                out.append("0")
            elif not (after == "C" and two == "H"):
                out.append("T")
        elif ch == "V":
            out.append("F")
        elif ch in "WY":
            if after in VOWELS and after:
                out.append(ch)
        elif ch == "X":
            out.append("KS")
        elif ch == "Z":
            out.append("S")
        else:
            out.append(ch)
    return "".join(out)
