"""Record shapes, and why a record is rejected."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, StringType, StructField, StructType

MESSAGES = "array<struct<role: string, content: string>>"
MESSAGE = StructType([StructField("role", StringType()), StructField("content", StringType())])
CHAT = StructType([StructField("messages", ArrayType(MESSAGE))])
INTENT = StructType(
    [StructField(n, StringType()) for n in ("intent_id", "persona_archetype", "governing_principle", "capability_layer", "user_intent", "context_summary", "application_prompt", "ideal_response_final")]
    + [StructField(n, ArrayType(StringType())) for n in ("ideal_response_attributes", "ideal_response_cot")]
)
PREFERENCE = StructType([StructField(n, StringType()) for n in ("prompt", "chosen", "rejected")])

BLANK, MALFORMED, NOT_OBJECT, NO_MESSAGES, EMPTY_MESSAGES, NO_USER, NO_ASSISTANT, MISSING_FIELD, EMPTY_TEXT = (
    "blank", "malformed", "not_object", "no_messages", "empty_messages", "no_user", "no_assistant", "missing_field", "empty_text",
)
