"""Readers and writers: raw tables, mailboxes, vectors, postings, reports."""
