"""lexweave.functions"""
