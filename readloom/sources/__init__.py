"""Readers and writers of sequence and report files."""
