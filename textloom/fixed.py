"""Fixed values.

Everything in this module is a value that results depend on: patterns, masks,
constants and formats.  They are stated here once and used by name elsewhere.
"""

# --- character classes (regex source, valid in java.util.regex) -------------
# Python's \s for str, Python's \w for str, and the \s of the word splitter,
# which leaves out U+001C to U+001F.
SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"
WORD = r"\p{L}\p{N}_"
SPLIT_SPACE = r"\t-\r\x20\x85\p{Z}"

# --- personal data ---------------------------------------------------------
EMAIL_MASK = "|||EMAIL_ADDRESS|||"
PHONE_MASK = "|||PHONE_NUMBER|||"
IP_MASK = "|||IP_ADDRESS|||"

_EDGE = rf"(?:(?<![{WORD}])(?=[{WORD}])|(?<=[{WORD}])(?![{WORD}]))"
# Dotted labels, none empty, then letters.  Written without a repeated group, which
# java.util.regex would match by recursion, one level for a label.
EMAIL = (
    _EDGE + r"[a-zA-Z0-9._%+-]+@(?=[a-zA-Z0-9-])(?:(?!\.\.)[a-zA-Z0-9.-])*\.[a-zA-Z]{2,}" + _EDGE
)
_SEP = rf"[{SPACE}\-.]?"
PHONE = (
    r"(?<!\p{Nd})(?:\+?\p{Nd}{1,3}" + _SEP + r")?(?:\(?\p{Nd}{2,4}\)?" + _SEP
    + r")\p{Nd}{3,4}" + _SEP + r"\p{Nd}{4}(?!\p{Nd})"
)
_OCTET = r"(?:25[0-5]|2[0-4]\p{Nd}|1?\p{Nd}?\p{Nd})"
IP = r"(?<!\p{Nd})" + r"\.".join([_OCTET] * 4) + r"(?!\p{Nd})"

# --- document quality ------------------------------------------------------
# The repeated group is possessive: it never has to give anything back, and so is
# matched without recursion.
WORD_TOKEN = (
    r"\.\.\.|[\p{L}\p{N}_]+(?:[-.,'’][\p{L}\p{N}_]+)*+"
    rf"|[^{SPACE}\p{{L}}\p{{N}}_]"
)
MIN_WORDS, MAX_WORDS = 50, 100_000
MIN_MEAN_LEN, MAX_MEAN_LEN = 3, 10
MAX_ELLIPSIS_LINES = 0.3
MIN_ALPHA_WORDS = 0.8
MIN_CHARS = 100

# --- safety gates and labels -----------------------------------------------
LABEL_HIGH = "__label__high "
LABEL_LOW = "__label__low "
GATE_SCORE = 0.75

# --- near duplicates -------------------------------------------------------
HASH_PRIME = 4294967311
HASH_SEED = 42
NUM_HASHES = 128
NUM_BANDS = 16
NGRAM = 4
JACCARD = 0.8

# --- tokenizer -------------------------------------------------------------
PRETOKEN = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPLIT_SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{SPLIT_SPACE}]+(?![^{SPLIT_SPACE}])|[{SPLIT_SPACE}]+"
)
BYTE_TOKENS = 256
END_OF_TEXT = "<|endoftext|>"

# --- training sets, evaluation, conversations -------------------------------
CONTEXT_LENGTH = 512
BATCH_SIZE = 16
VALID_SHARE = 0.1
PAD_ID = 0
MIN_TEMPERATURE = 1e-5
QUIT_WORDS = ("quit", "exit")
