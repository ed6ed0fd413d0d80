"""The fixed ontology and thresholds, as data. Validation joins against these instead of branching in Python."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Labels, edge names with the labels they join, relations with the types they join, type domains,
# enumerations, word lists and thresholds must be exactly these for results to be right.
LABELS = ("Agent", "Role", "Topic", "Type", "Source", "Description", "Contradiction")
EDGE_LABELS = {
    "role_in_meeting": ("Agent", "Role"),
    "role_in_paper": ("Agent", "Role"),
    "spoke_about": ("Agent", "Topic"),
    "writes_about": ("Agent", "Topic"),
    "has_source": ("Topic", "Source"),
    "has_subtopic": ("Topic", "Topic"),
    "relates_to": ("Topic", "Topic"),
    "assigned_to": ("Topic", "Agent"),
    "has_contradiction": ("Description", "Contradiction"),
}
RELATIONS = {
    "addresses": (["method"], ["problem", "research goal"]),
    "resolves": (["decision"], ["issue", "open question"]),
    "produces": (["decision"], ["action item"]),
    "evaluates": (["experiment", "metrics evaluation"], ["result"]),
    "uses": (["method", "experiment"], ["dataset"]),
    "motivates": (["background", "research gap", "problem"], ["method", "research goal"]),
    "identifies": (["background", "existing research"], ["research gap"]),
    "extends": (["method"], ["existing research", "theoretical basis"]),
    "compares_to": (["result"], ["existing research", "result"]),
    "contradicts": (["result", "feedback"], ["result", "idea", "decision"]),
    "responds_to": (["feedback"], ["idea", "decision", "progress update", "method", "result", "limitation"]),
    "follows_up_on": (["progress update"], ["progress update", "action item"]),
}
PAPER_TYPES = (
    "background", "problem", "research goal", "theoretical basis", "dataset", "conclusion", "future work", "existing research",
    "research gap", "method", "experiment", "result", "metrics evaluation", "limitation",
)
MEETING_TYPES = (
    "issue", "idea", "decision", "action item", "open question", "progress update", "feedback", "meeting procedure", "claim",
    "observation", "rationale", "assumption", "heuristic", "prediction", "option", "evidence", "constraint", "risk", "trade off",
    "exception", "uncertainty", "condition", "rule", "action", "outcome", "disagreement",
)
STATUSES = ("open", "in_progress", "done", "blocked")
STANCES = ("raised", "proposed", "decided", "reported", "gave_feedback")
LEVELS = ("direct", "partial", "apparent")
ALLOWED_TYPES = ("Result", "Metrics Evaluation", "Conclusion", "Decision", "Progress Update")
SCOPE_TYPES = ("Method", "Dataset", "Experiment")
GENERIC_TOPICS = (
    "method", "methods", "methodology", "performance", "system", "results", "result", "evaluation", "experiment", "experiments",
    "approach", "model", "framework", "analysis", "discussion", "introduction", "background", "overview", "summary", "conclusion",
    "future work", "findings", "output", "business performance", "financial performance", "operational performance", "data",
)
REPORTING_VERBS = (
    "shows?", "summarizes?", "reveals?", "identifies?", "presents?", "outlines?", "specifies?", "indicates?", "suggests?", "demonstrates?",
)
COSMETIC_NOTES = ("pdf_ligature", "line_break_hyphenation")
MEETING_KINDS = ("meeting", "transcript", "minutes", "vtt", "srt", "recording", "audio")
PAPER_KINDS = ("pdf", "paper", "thesis", "article", "journal", "docx", "tex")
FRAGMENT_WORDS = ("Table", "Tab", "Figure", "Fig", "Section", "Sec", "Chapter", "Ch", "Appendix", "App", "Equation", "Eq")
SUPERSESSION_BASES = ("explicit_correction", "citing_contrast", "claimed_improvement", "retraction")
RESOLUTIONS = ("scope_difference", "known_controversy", "unresolved", "insufficient_evidence", "not_a_conflict")
NLI_LABELS = ("contradiction", "entailment", "neutral", "unclear")
DIGITS_HAN = "〇零一二三四五六七八九"

SOURCE_CAP = 3
TOPIC_SIMILARITY = 0.92
SPEECH_CHARS = 70
SHORT_TEXT = 40
SAME_TEXT_RATIO = 0.9
REJECT_CONFIDENCE = 0.8
KNN, SIMILARITY_FLOOR = 15, 0.85
CLUSTER_MOST = 5
PARTIAL_FACTOR = 0.7
YEARS = (1900, 2100)
BLOCKING_VERSION, GATE_VERSION, CLASSIFICATION_VERSION = "blocking-v1", "gate-v1", "classification-v2"
NLI_PROMPT, SUPERSESSION_PROMPT, CLUSTER_PROMPT = "nli-v2", "supersession-v1", "classification-v3"


def edge_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(e, a, b) for e, (a, b) in EDGE_LABELS.items()], "rel string, src_label string, dst_label string")


def relation_pairs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(r, a, b) for r, (a, b) in RELATIONS.items()], "relation string, src_types array<string>, dst_types array<string>")


def type_domains(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t, "paper") for t in PAPER_TYPES] + [(t, "meeting") for t in MEETING_TYPES], "type string, domain string")
