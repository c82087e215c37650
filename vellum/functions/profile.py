"""Who a collection is about: the names that rules mention, given as data."""

from __future__ import annotations

import re
from dataclasses import dataclass


@dataclass(frozen=True)
class Profile:
    """Names of the maker whose works are collected.

    ``given`` are given names and their spellings, ``middle`` other name parts,
    ``family`` the family name, ``others`` patterns of people often confused with
    the maker. All may be empty; rules that mention names then never apply.
    ``first_year`` and ``last_year`` bound the working life, ``birth_year`` is
    not a year of a work.
    """

    given: tuple[str, ...] = ()
    middle: tuple[str, ...] = ()
    family: str = ""
    others: tuple[str, ...] = ()
    first_year: int = 1904
    last_year: int = 1970
    birth_year: int = 1885

    @property
    def any_given(self) -> str:
        return "|".join(map(re.escape, self.given)) or r"(?!)"

    @property
    def words(self) -> tuple[str, ...]:
        return tuple(w.lower() for w in (*self.given, *self.middle, self.family) if w)

    @property
    def full(self) -> str:
        """A pattern of the full name, with or without a middle part or initial."""
        if not (self.given and self.family):
            return r"(?!)"
        middle = "|".join([*map(re.escape, self.middle), r"[a-z]\."])
        return rf"(?:{self.any_given})\s+(?:(?:{middle})\s*)?{re.escape(self.family)}"
