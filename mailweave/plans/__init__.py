"""Composed pipelines: mailbox build, search, evaluation."""
