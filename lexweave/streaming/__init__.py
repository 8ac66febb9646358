"""lexweave.streaming"""
