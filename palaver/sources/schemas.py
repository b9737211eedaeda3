"""Declared schemas of stored datasets and exports."""

from __future__ import annotations

COMMON = ("conversation_id string, num_turns bigint, num_messages bigint, system_prompt string, "
          "messages string, total_characters bigint, estimated_tokens bigint, "
          "cumulative_char_lengths string")
FAMILY_EXTRAS = {
    "text": "topic string", "reasoning": "topic string", "random": "topic string",
    "repeat": "topic string",
    "pdf": "conversation_type string, paper_arxiv_id string, paper_title string, "
           "paper_pdf_url string, paper_categories string",
    "image": "conversation_type string, image_title string, image_url string, image_topic string, "
             "source_article string, image_width bigint, image_height bigint",
    "agentic": "task_type string, tool_calls string, success_metric string, success_score double, "
               "num_tool_calls bigint, num_errors bigint",
}
SESSION = "session_id string, turns array<struct<text:string>>"
TRACE = ("session_id string, messages array<struct<role:string,content:string>>, "
         "output_length bigint, delay bigint")
PAPER = ("arxiv_id string, title string, authors array<string>, abstract string, "
         "categories array<string>, primary_category string, published string, pdf_url string, "
         "entry_url string")
IMAGE = ("title string, url string, width bigint, height bigint, mime_type string, "
         "description string, artist string, license string, topic string, source_article string")


def family_schema(family: str) -> str:
    """Columns of one family; ``mixed`` has the union plus the source name."""
    if family == "mixed":
        names: dict[str, str] = {}
        for extra in FAMILY_EXTRAS.values():
            for field in extra.split(", "):
                names[field.split(" ")[0]] = field
        return ", ".join([COMMON, *names.values(), "source_dataset string"])
    return f"{COMMON}, {FAMILY_EXTRAS[family]}"
