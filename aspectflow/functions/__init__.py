from aspectflow.functions.text import (  # noqa: F401
    clean, keep_vietnamese, normalise_spaces, remove_tone, strip_unicode_ws, tokenize,
)
from aspectflow.functions.scores import (  # noqa: F401
    argmax, cross_entropy, head_logits, label_name, logsumexp,
)
from aspectflow.functions.codec import (  # noqa: F401
    b64_decode, b64_encode, counts_from_json, proportional_height,
)
