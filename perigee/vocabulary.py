"""Names and texts that appear in stored rows and so must not vary."""

# Source systems and the identifier names each one publishes.
APPROACH_FEED = "neows"
CATALOG_FEED = "sbdb"
RISK_FEED = "sentry"

RESOLVED = "RESOLVED"
UNRESOLVED = "UNRESOLVED"
AMBIGUOUS = "AMBIGUOUS"
INVALID = "INVALID"
MATCH_STATES = [RESOLVED, UNRESOLVED, AMBIGUOUS, INVALID]
# Larger is more conservative.
STATE_SEVERITY = {RESOLVED: 1, UNRESOLVED: 2, INVALID: 3, AMBIGUOUS: 4}

# Match rules.
PIVOT = "CANONICAL_EXTERNAL_PIVOT"
CATALOG_DESIGNATION = "CANONICAL_ASSOCIATED_IDENTIFIER"
EXACT_SPKID = "EXACT_SPKID_MATCH"
EXACT_DESIGNATION = "EXACT_DESIGNATION_MATCH"
EXACT_FULLNAME = "EXACT_FULLNAME_MATCH"
ALTERNATE_DESIGNATION = "ALTERNATE_DESIGNATION_MATCH"
RISK_ID_BY_DESIGNATION = "ASSOCIATED_SENTRY_ID_VIA_DESIGNATION"
NO_MATCH = "NO_CROSS_SOURCE_MATCH"
COLLISION = "DUPLICATE_COLLISION_QUARANTINE"
CONTRADICTION = "CONTRADICTORY_CANDIDATE_QUARANTINE"
INVALID_IDENTIFIER = "INVALID_IDENTIFIER"
# Rules given when only the bridge, or nothing, answers for an identifier.
BRIDGE_EXACT = "BRIDGE_EXACT_NEOWS_ID"
BRIDGE_SEVERAL = "BRIDGE_MULTIPLE_CANDIDATE_KEYS"
NO_RECORD = "NO_RESOLUTION_RECORD"
INVALID_SYNTAX = "INVALID_SYNTAX"

# Sentences served as evidence where no audit row answers.
EVIDENCE_TEXT = {
    INVALID_SYNTAX: "NeoWs identifier must contain only numeric digits.",
    BRIDGE_EXACT: "Deterministic exact match in canonical entity bridge fallback.",
    BRIDGE_SEVERAL: "Identifier maps to %d distinct candidate entity keys in bridge fallback.",
    NO_RECORD: "No crosswalk record found for this NeoWs identifier.",
}

# Presence states.
NEW_ENTRY = "NEW_ENTRY"
PERSISTENT = "PERSISTENT"
RE_ENTRY = "RE_ENTRY"
EXIT = "EXIT_AFTER_THIS_SNAPSHOT"

# Observation quality tiers.
UNREPORTED = "UNREPORTED"
WELL_CONSTRAINED = "ADEQUATELY_CONSTRAINED"
LIMITED_ARC = "FOLLOWUP_PRIORITY_LIMITED_ARC"

# Availability statuses and reasons.
AVAILABLE, PARTIAL, UNAVAILABLE = "available", "partial", "unavailable"
NOT_RESOLVED, NOT_PRESENT = "not_resolved", "not_present"
LINK_AMBIGUOUS, LINKED_NO_RECORD = "ambiguous", "linked_no_record"
NOT_IN_SOURCE, NOT_IN_CONTRACT, AMBIGUOUS_LINKAGE = "not_in_source", "not_in_current_contract", "ambiguous_linkage"
UNAVAILABLE_REASONS = [NOT_RESOLVED, NOT_IN_SOURCE, NOT_IN_CONTRACT, AMBIGUOUS_LINKAGE]

CLOSEST_APPROACH_RULE = "CLOSEST_OBSERVED_APPROACH"
LUNAR_DISTANCE_KM = 384400.0
KEY_NAMESPACE = "e7b8c9d0-1234-5678-9abc-def012345678"
DIRECTION_SALT = "nasa-asteroid-world/illustrative-direction/v1:"
DIRECTION_ALGORITHM = "sha256-uniform-sphere-v1"
DIRECTION_SEMANTICS = "illustrative"

# Check statuses.
PASSED, FAILED, WARNING = "PASSED", "FAILED", "WARNING"
BLOCKED, NOT_APPLICABLE = "BLOCKED", "NOT_APPLICABLE"
PRODUCTION, BACKFILL = "CURRENT_PRODUCTION", "HISTORICAL_BACKFILL"

# A map key holding any of these is dropped from manifests.
SENSITIVE_WORDS = [
    "api_key", "nasa_api_key", "aws_access_key_id", "aws_secret_access_key",
    "secret", "token", "password", "authorization",
]
