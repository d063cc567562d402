"""Fixed patterns: personal-data formats and value-type literals.

None of them uses look-around, so the same text means the same thing in Java's
regex and in RE2.  Type literals are anchored at the true end of the text
(``\\z``): ``$`` would also accept a trailing newline.
"""

# Personal-data and link formats, searched for anywhere in the text.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
URL = r"https?://[^\s\"<>]+"
SOCIAL_SECURITY_NUMBER = r"\b\d{3}-\d{2}-\d{4}\b"
CREDIT_CARD = r"\b(?:\d[ -]?){13,16}\b"

# What any text must contain for one of these to be found in it: looking for it first spares
# most texts the pattern.
NEEDED = {EMAIL: "@", URL: "://", SOCIAL_SECURITY_NUMBER: "-"}

# Literals that decide the type of a text value.
INTEGRAL = r"^[-+]?\d+\z"
FRACTIONAL = r"^[-+]?(\d+\.\d*|\.\d+)\z"
BOOLEAN = ("true", "false")
# Every numeric or boolean literal starts with one of these, so a text that does not
# is a String without running a pattern over it.
LITERAL_STARTS = tuple("+-.0123456789tf")

# The names of the value types, in the order they are reported.
VALUE_TYPES = ("Unknown", "Fractional", "Integral", "Boolean", "String")
