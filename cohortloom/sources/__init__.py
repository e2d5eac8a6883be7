"""Readers and writers for cohort folders, label maps and scratch tables."""
