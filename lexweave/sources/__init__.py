"""lexweave.sources"""
