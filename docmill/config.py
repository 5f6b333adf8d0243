"""Parameters and fixed values of the passage builder."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ChunkConfig:
    """Sizes are code points; ``max_chars`` is the hard bound of a passage."""

    size: int = 800
    overlap: int = 100
    max_section: int = 1500
    min_chars: int = 80
    max_chars: int = 2500


# Headings whose own section is boilerplate, matched as substrings of the normalised heading.
BOILERPLATE_SECTION = (
    "contents", "table of contents", "index", "acknowledg", "glossary", "acronym", "abbreviat", "references", "bibliography", "foreword", "preface", "disclaimer",
    "list participants", "contributors", "your responsibility", "recommendations for research", "key recommendations for research",
    "other recommendations for research", "declarations of conflicts", "declarations of conflict", "conflict of interest", "conflicts of interest",
    "guideline development group members", "members of the guideline development group", "members of the who steering group", "members of the who secretariat",
    "membership of the programme development group", "membership of the guideline committee", "programme development group", "nice project team", "external contractors",
    "external experts and who staff involved in the preparation of this guideline", "external resource experts", "who secretariat", "evidence secretariat",
    "guideline working party", "stakeholder consultation", "committee details", "update information",
)
# Of these, the ones that do not make the sections below them boilerplate.
OWN_SECTION_ONLY = ("references", "bibliography", "declarations of conflicts", "declarations of conflict", "conflict of interest", "conflicts of interest")
BOILERPLATE_SUBTREE = tuple(p for p in BOILERPLATE_SECTION if p not in OWN_SECTION_ONLY)
# Fixed pattern: headings of forms and logs.
TEMPLATE_HEADING = r"\b(?:forms?|checklists?|record forms?|report forms?|observation charts?|logs?)\b"
# Sources that repeat others and are skipped by default.
SKIP_SOURCES = ("WHO_ANCExSummary_2016", "WHO_PositiveBirthExSum_2018")
