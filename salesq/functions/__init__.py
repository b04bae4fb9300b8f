from salesq.functions.expr import (  # noqa: F401
    MISSING_TOKENS, count_if, money, np_round, null_if_token, safe_div, to_flag,
)
