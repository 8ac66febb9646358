"""lexweave.operators"""
