"""Training-data operators: packing, search, extraction, scoring, dedup, chat, language, tokens.

Nothing outside this package imports it; its queries are in ``roaskit.llm.queries``.
"""
