"""Operators for preparing training text: one module each, registered by ``readloom.llm.queries``."""
