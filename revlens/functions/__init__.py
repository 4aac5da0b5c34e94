"""Column expressions (JVM-side, codegen-friendly; no Python UDFs)."""

from revlens.functions.labels import (  # noqa: F401
    confidence_band,
    health_status,
    is_correct,
    label_name,
    parse_score,
    score_label,
    sentiment_index,
    sentiment_value,
)
from revlens.functions.numeric import ratio_half_up  # noqa: F401
from revlens.functions.text import (  # noqa: F401
    bigrams,
    clean_text,
    full_text,
    text_preview,
    tokens,
    without_stop_words,
)
