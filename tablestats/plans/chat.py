"""Chat-model request and answer tables.

The network call itself is not part of the library: requests are built as
JSON text columns (one per prompt row) that any HTTP client can send, and
answers come back as a column of response bodies that ``chat_content``
parses.  Both are plain column expressions, so any number of prompts is
handled in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default model, sampling settings and analyst instructions.
DEFAULT_MODEL = "mistralai/mistral-7b-instruct-v0.3"
DEFAULT_TEMPERATURE = 0.5
DEFAULT_MAX_TOKENS = -1
DEFAULT_INSTRUCTIONS = (
    "You are a professional steam data analyst, your task is to interpret the provided data and give useful\n"
    "and to the point explanations.\n\n"
    "Generate a human-friendly narrative of your findings.\n\n"
    "Do not talk about the dataset it self, only the results that are found.\n\n"
    "Produce a short explanation written in a friendly, simple tone.\n\n"
    "Here is the analysis report you should base your answer on:\n\n"
)

ANSWER_SCHEMA = "struct<choices: array<struct<message: struct<content: string>>>>"

# Answer outcomes.
STATUS_OK = "ok"
STATUS_NO_CHOICES = "no_choices"
STATUS_EMPTY = "empty"
STATUS_BAD_JSON = "bad_json"


def chat_requests(df: DataFrame, prompt: str = "prompt", model: str = DEFAULT_MODEL,
                  temperature: float = DEFAULT_TEMPERATURE, max_tokens: int = DEFAULT_MAX_TOKENS,
                  out: str = "request") -> DataFrame:
    """Add a JSON request body: model, one user message, temperature, max_tokens, stream=false."""
    message = F.struct(F.lit("user").alias("role"), F.col(prompt).alias("content"))
    body = F.struct(
        F.lit(model).alias("model"),
        F.array(message).alias("messages"),
        F.lit(float(temperature)).alias("temperature"),
        F.lit(int(max_tokens)).alias("max_tokens"),
        F.lit(False).alias("stream"),
    )
    return df.withColumn(out, F.to_json(body))


def chat_content(df: DataFrame, body: str = "body", content: str = "content",
                 status: str = "status") -> DataFrame:
    """Add the answer text ``choices[0].message.content`` and an outcome.

    status: bad_json (body is not JSON), no_choices (missing or empty
    ``choices``), empty (no or empty content), ok.  content is null unless ok.
    """
    raw = F.col(body)
    parsed = F.from_json(raw, ANSWER_SCHEMA)
    choices = parsed.getField("choices")
    text = F.get(choices, 0).getField("message").getField("content")
    outcome = (F.when(F.get_json_object(raw, "$").isNull(), F.lit(STATUS_BAD_JSON))
                .when(choices.isNull() | (F.size(choices) < 1), F.lit(STATUS_NO_CHOICES))
                .when(text.isNull() | (text == ""), F.lit(STATUS_EMPTY))
                .otherwise(F.lit(STATUS_OK)))
    return (df.withColumn(status, outcome)
              .withColumn(content, F.when(F.col(status) == STATUS_OK, text)))
