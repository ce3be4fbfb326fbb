"""Row shapes shared by the sources and the operators."""

REQUIREMENT = (
    "framework STRING, id STRING, title STRING, description STRING, tags ARRAY<STRING>, pos BIGINT"
)
NODE = (
    "framework STRING, path STRING, section_ord INT, section STRING, node_nums ARRAY<BIGINT>, "
    "node_titles ARRAY<STRING>, node_prefixes ARRAY<STRING>, "
    "n BIGINT, label STRING, desc STRING, prefix STRING, pos BIGINT"
)
CELL = "framework_A STRING, framework_B STRING, pos_A BIGINT, pos_B BIGINT, semantic_score DOUBLE"
GRID = (
    "framework_A STRING, framework_B STRING, pos_A ARRAY<BIGINT>, pos_B ARRAY<BIGINT>, "
    "scores ARRAY<DOUBLE>"
)
GRID_STRIP = (
    "framework_A STRING, framework_B STRING, first_A BIGINT, first_B BIGINT, "
    "low_A BIGINT, high_A BIGINT, low_B BIGINT, high_B BIGINT, low DOUBLE, high DOUBLE"
)
GRID_SUMMARY = (
    "framework_A STRING, framework_B STRING, cells BIGINT, total DOUBLE, low DOUBLE, high DOUBLE"
)
RELATION_COLUMNS = (
    "framework_A", "id_A", "title_A", "framework_B", "id_B", "title_B",
    "semantic_score", "coverage_A_to_B", "coverage_B_to_A", "confidence",
    "relation_type", "justification",
)
CONFIG_ENTRY = (
    "STRUCT<groups: MAP<STRING, STRING>, flatGroups: ARRAY<STRING>, "
    "overwriteGroupsId: MAP<STRING, INT>, complianceNA: MAP<STRING, ARRAY<STRING>>>"
)
