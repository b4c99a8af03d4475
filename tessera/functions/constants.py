"""Fixed values that results depend on.

Everything in this module is a value that must stay exactly as written for results to
match the behaviour we reproduce: word lists, rule tables, regular expressions, weights,
templates and defaults.  They are kept together, in their natural order, as plain text.
Order matters wherever a rule says "first match wins" or "ties go to the earlier entry".
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: document windows and pyramid
# ---------------------------------------------------------------------------
PAGE_CHARS = 2000
WINDOW_PAGES = 2
OVERLAP_CHARS = 400
SUMMARY_SENTENCES = 3
KEYWORDS_TOP_K = 15

STOPWORDS = [
    "a", "an", "the", "is", "are", "was", "were", "be", "been", "being", "have", "has",
    "had", "do", "does", "did", "will", "would", "could", "should", "may", "might",
    "shall", "can", "to", "of", "in", "on", "at", "by", "for", "with", "about", "from",
    "that", "this", "these", "those", "it", "its", "not", "and", "or", "but", "if",
]

# Category -> keywords, in rule order (ties go to the earlier category).
CATEGORY_RULES = [
    ("Machine Learning / AI", [
        "neural", "model", "training", "dataset", "accuracy", "loss", "gradient",
        "deep", "learning", "transformer", "embedding", "inference", "llm", "gpt",
        "bert", "fine-tune", "lora", "tokenize", "epoch", "batch", "overfitting",
    ]),
    ("Mathematics", [
        "equation", "theorem", "proof", "integer", "prime", "matrix", "vector",
        "calculus", "derivative", "integral", "algebra", "geometry", "probability",
        "statistics", "distribution", "variance", "correlation",
    ]),
    ("Natural Language Processing", [
        "nlp", "text", "corpus", "sentence", "token", "parse", "syntax", "semantic",
        "sentiment", "classification", "summarization", "ner", "pos", "dependency",
    ]),
    ("Software Engineering", [
        "api", "function", "class", "module", "library", "framework", "database",
        "schema", "query", "server", "client", "architecture", "design", "pattern",
    ]),
]
FALLBACK_CATEGORY = "General / Other"

# Search: level names in tie-break order and their composite weights.
LEVELS = ["raw", "summary", "keywords"]
LEVEL_WEIGHTS = {"raw": 0.40, "summary": 0.35, "keywords": 0.25}
COSINE_EPSILON = 1e-9
SEARCH_TOP_K = 3

# ---------------------------------------------------------------------------
# FIXED VALUES: query classifier (applied to the lower-cased query, case-insensitive)
# ---------------------------------------------------------------------------
CLASSIFIER_RULES = [
    ("math", [
        r"\b(calculate|compute|solve|equation|how many|how much|total|sum|"
        r"product|divide|multiply|percent|ratio|rate|average|mean|median|"
        r"profit|loss|discount|tax|area|perimeter|volume|speed|distance)\b",
        r"\d+\s*[\+\-\*\/\^]\s*\d+",
        r"\b\d+\s*(apples?|students?|items?|dollars?|\$|km|m|kg)\b",
    ]),
    ("legal", [
        r"\b(law|legal|court|judgment|liability|contract|clause|statute|"
        r"regulation|compliance|rights?|obligation|breach|damages?|"
        r"intellectual property|patent|copyright|trademark|GDPR|HIPAA|"
        r"lawsuit|settlement|defendant|plaintiff|appeal|jurisdiction)\b",
    ]),
    ("code", [
        r"\b(code|function|algorithm|debug|error|bug|implement|python|"
        r"javascript|sql|api|class|variable|loop|recursion|data structure|"
        r"time complexity|space complexity|runtime)\b",
        r"```",
        r"def |class |import |#include",
    ]),
    ("science", [
        r"\b(biology|chemistry|physics|quantum|molecule|atom|cell|DNA|"
        r"evolution|gravity|relativity|thermodynamics|photosynthesis|"
        r"ecosystem|neural|neuron|experiment|hypothesis|theory)\b",
    ]),
    ("general", []),
]
QUERY_TYPES = ["math", "legal", "code", "science", "general"]
PATTERN_WEIGHT = 1.0
STRUCTURE_WEIGHT = 1.5
HAS_NUMBERS_PATTERN = r"\b\d+\b"
HAS_OPERATOR_PATTERN = r"[\+\-\*\/\=\^]"
CODE_FENCE_MARKERS = ["```", "def "]
QUESTION_WORD_PATTERN = r"^(who|what|when|where|why|how)\b"

# ---------------------------------------------------------------------------
# FIXED VALUES: handlers
# ---------------------------------------------------------------------------
ARITH_RUN_PATTERN = r"([\d\s\+\-\*\/\(\)\.]+)"
WORD_NUMBER_PATTERN = r"\d+(?:\.\d+)?"
# operation -> unanchored pattern on the lower-cased query; first hit wins.
WORD_OPERATIONS = [
    ("addition", "total|sum|combined|together|add"),
    ("subtraction", "left|remain|differ|subtract|less"),
    ("multiplication", "each|per|every|times|product"),
    ("division", "split|share|divide|group|per"),
]
MATH_ARITH_CONFIDENCE = 0.92
MATH_WORD_CONFIDENCE = 0.70
MATH_UNABLE = "Unable to extract a definitive numeric answer. Please reformulate."
MATH_DIV_ZERO = "Cannot divide by zero."

LEGAL_DOMAINS = [
    ("contract", r"\b(contract|agreement|clause|breach|obligation|party)\b"),
    ("intellectual", r"\b(patent|copyright|trademark|ip|intellectual property)\b"),
    ("compliance", r"\b(GDPR|HIPAA|CCPA|regulation|compliance|data protection)\b"),
    ("litigation", r"\b(lawsuit|court|judge|plaintiff|defendant|settlement|damages)\b"),
    ("employment", r"\b(employee|employer|termination|discrimination|severance|HR)\b"),
]
JURISDICTIONS = ["US", "EU", "UK", "India", "California", "federal"]
LEGAL_CONFIDENCE = 0.60

CODE_LANGUAGES = [
    ("python", r"\b(python|def |import |\.py|pandas|numpy|sklearn)\b"),
    ("javascript", r"\b(javascript|js|node|npm|async|await|const|let)\b"),
    ("sql", r"\b(sql|select|from|where|join|insert|update|delete)\b"),
    ("java", r"\b(java|class |public |private |static |void )\b"),
    ("c/c++", r"\b(c\+\+|#include|malloc|pointer|struct)\b"),
]
CODE_TASKS = [
    ("debug", r"\b(bug|error|fix|debug|not working|failing|exception)\b"),
    ("implement", r"\b(write|implement|create|build|code|make)\b"),
    ("explain", r"\b(explain|what is|how does|understand|mean)\b"),
    ("optimise", r"\b(optim|faster|efficient|performance|complexity)\b"),
]
CODE_CONFIDENCE = 0.80
SCIENCE_ANSWER = ("Activating scientific reasoning: concept identification → "
                  "principle retrieval → explanation.")
SCIENCE_CONFIDENCE = 0.75
SCIENCE_TRACE = ["Identified as science query", "Routing to domain-specific knowledge base"]
GENERAL_PREFIX = "Activating general semantic search for: "
GENERAL_CONFIDENCE = 0.50
GENERAL_TRACE = ["No specialised module matched", "Falling back to general knowledge retrieval"]
LOG_QUERY_CHARS = 100

# ---------------------------------------------------------------------------
# FIXED VALUES: SFT preparation and evaluation
# ---------------------------------------------------------------------------
SYSTEM_PROMPT = (
    "You are a helpful math tutor. Solve the following problem step-by-step "
    "and provide the final numerical answer after '####'."
)
PROMPT_TEMPLATE_HEAD = "### System:\n"
PROMPT_TEMPLATE_QUESTION = "\n\n### Question:\n"
PROMPT_TEMPLATE_ANSWER = "\n\n### Answer:\n"
ANSWER_MARKER_PATTERN = r"####\s*([\d,\.\-]+)"
ANSWER_FALLBACK_PATTERN = r"\b\d[\d,\.]*\b"
SEED = 42
TRAIN_SAMPLES = 3000
EVAL_SAMPLES = 1000
MAX_SEQ_LEN = 512
BATCH_SIZE = 4
GRAD_ACCUM_STEPS = 4
NUM_EPOCHS = 3
LOGGING_STEPS = 50
SAVE_STEPS = 500
TOKENS_PER_CHAR = 1.3
LABEL_IGNORE_ID = -100

# Q/A word-problem templates: (question, answer, kind).  Placeholders {a} {b} {d} {r}.
QA_TEMPLATES = [
    ("If Alice has {a} apples and gives {b} to Bob, how many does she have?",
     "Alice starts with {a} apples.\nShe gives away {b}.\nRemaining: {a} - {b} = {r}\n#### {r}",
     "gives"),
    ("A store sells {a} items per day at ${b} each. What is the weekly revenue?",
     "Daily revenue = {a} × {b} = {d}\nWeekly revenue = {d} × 7 = {r}\n#### {r}",
     "weekly"),
    ("There are {a} students. Each group has {b} students. How many groups?",
     "{a} ÷ {b} = {r} groups\n#### {r}",
     "groups"),
    ("A rectangle is {a} m wide and {b} m long. What is its area?",
     "Area = {a} × {b} = {r} m²\n#### {r}",
     "area"),
    ("Tom saves ${a} per week. How much does he save in {b} weeks?",
     "Savings = {a} × {b} = {r}\n#### {r}",
     "savings"),
]
QA_A_RANGE = (5, 50)
QA_B_RANGE = (2, 20)
