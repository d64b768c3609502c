"""Names shared by all plans. Fixed values of the business domain."""

# Milestone phases in order of occurrence and the date that opens each of them.
PHASES = {
    "IO": "start_date",
    "CC": "concrete_date",
    "ME": "assembly_date",
    "OT": "test_date",
}
NOT_STARTED = "OUT"
PHASE_ORDER = {"OUT": 0, "IO": 1, "CC": 2, "ME": 3, "OT": 4}
# Generation types without a concrete phase, and the type split into one plant per unit.
NO_CONCRETE_TYPES = ["UFV", "UTE"]
SPLIT_TYPE = "UHE"
TYPE_ALIASES = {"UTN": "UTE"}

ALL_MARKETS = "Ambos"
REGULATED = "ACR"
FREE = "Fora do ACR"
LEVELS = [ALL_MARKETS, REGULATED, FREE]

YES, NO = "Sim", "Não"
TRIM_Z = 1.65
SEGMENT = ["gen_type", "phase", "level"]
