"""Report and chat plans built from the operators."""

from tablestats.plans.chat import chat_content, chat_requests
from tablestats.plans.report import prompt_text, report_lines, summary_lines

__all__ = ["chat_content", "chat_requests", "prompt_text", "report_lines", "summary_lines"]
