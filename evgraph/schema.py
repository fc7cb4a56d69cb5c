"""Fixed vocabularies and record types of the evidence graph."""

from __future__ import annotations

# Node types.
NODE_TYPES = (
    "agency",
    "subagency",
    "program_office",
    "contracting_office",
    "program",
    "person",
    "solicitation",
    "award",
    "company",
)

# Relationship weights; any other relationship weighs DEFAULT_WEIGHT.
ROLE_WEIGHTS = {
    "owns_mission": 4.0,
    "owns_program": 4.0,
    "funds": 3.0,
    "procures_for": 3.0,
    "administers": 2.0,
    "holds": 1.0,
}
DEFAULT_WEIGHT = 0.5

# Evidence fields every relationship must carry, in report order.
EVIDENCE_FIELDS = ("source_url", "observed_at", "confidence")

# Evidence kinds: True where the kind may establish ownership by itself,
# False where it only proposes a candidate.
EVIDENCE_KINDS = {
    "explicit_owner": True,
    "office_code": True,
    "poc_context": True,
    "contracting_office": False,
    "industry_code": False,
    "notice_prefix": False,
    "semantic": False,
    "awarding_office": False,
    "incumbent": False,
    "platform_name": False,
}
DECISIVE_KINDS = tuple(kind for kind, decisive in EVIDENCE_KINDS.items() if decisive)

# Roles an office may play for one opportunity; never merged into one.
OPPORTUNITY_ROLES = ("owner", "program_management", "funding", "technical", "contracting", "award")

# Acquisition life-cycle stages a source can cover.
SOURCE_STAGES = (
    "organization",
    "people",
    "agency_intent",
    "congressional",
    "planned",
    "systems",
    "active",
    "award",
)

# Contact categories: first matching pattern on the lower-cased raw title wins.
ROLE_RULES = (
    ("small business", "small_business"),
    ("contracting (officer|specialist)", "contracting"),
    ("acquisition|procur", "acquisition_authority"),
    ("requirement", "requirement_ownership"),
    ("technical|engineer|scien", "technical"),
    ("program (manager|executive)|deputy|director", "program_leadership"),
)

# Need classes from strongest to weakest, with the weight of one signal.
NEED_CLASSES = {"funded": 5, "forecast": 4, "recurring": 3, "emerging": 2, "inferred": 1}

# Gold-suite classes and the least number of cases (and distinct offices) each needs.
GOLD_MINIMA = {
    "positive_single_program": (3, 3),
    "negative_non_target": (3, 0),
    "abstain_insufficient_owner": (2, 0),
    "multi_program_support": (2, 0),
    "legacy_mapping_review": (2, 0),
}

# Blocking gates: metric, comparison, threshold.
GATES = (
    ("exact_accuracy", ">=", 1.0),
    ("target_precision", ">=", 1.0),
    ("hard_negative_fpr", "<=", 0.0),
    ("correct_abstention", ">=", 1.0),
    ("multi_collapsed", "<=", 0.0),
    ("legacy_force_mapped", "<=", 0.0),
)
