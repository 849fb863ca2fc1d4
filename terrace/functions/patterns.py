"""Patterns for personal data and secrets in free text.

Only syntax that means the same in every common regex engine is used (no look-around, no
word boundaries).
"""

# A number from 0 to 255.
OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

# Name -> pattern, longest match first, as they are applied in this order.
SENSITIVE = {
    "token": r'token = "[0-9a-f]+"',
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "card": r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}",
    # ten digits after +1 in their usual groups, or a country code and two to four groups
    "phone": r"\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\+[1-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{2,4}\)?){2,4}",
    "ip": r"\.".join([OCTET] * 4),
    # a name of a secret, then a value of eight or more characters that holds a digit
    "secret": r'(?i:secret|password|passwd|api|access|private|auth)[_-]?(?i:key|token|secret)?"? ?[:=] ?"?[A-Za-z/+_-]{0,32}[0-9][0-9A-Za-z/+_-]{7,}',
}

# Text that every match of the pattern contains, a cheap test before the costly one.
ALWAYS_THERE = {
    SENSITIVE["token"]: 'token = "',
    SENSITIVE["email"]: "@",
    SENSITIVE["phone"]: "+",
}
