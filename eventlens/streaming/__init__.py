"""Structured Streaming forms of the operators: runner, built-in stateful
forms and ``transformWithState`` processors."""
