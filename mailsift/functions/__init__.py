"""Column -> Column scalars."""

from mailsift.functions.mail import local_date, normalise_address, parse_mail_date
from mailsift.functions.params import normalise_term_list, normalise_terms, parse_flag
from mailsift.functions.text import (
    badge_list, blank_to_null, escape_html, format_generated_on, format_tag,
    html_host, numbered_entry, preview_list, remove_title, ustrip,
)

__all__ = [
    "badge_list", "blank_to_null", "escape_html", "format_generated_on", "format_tag",
    "html_host", "local_date", "normalise_address", "normalise_term_list",
    "normalise_terms", "numbered_entry", "parse_flag", "parse_mail_date",
    "preview_list", "remove_title", "ustrip",
]
