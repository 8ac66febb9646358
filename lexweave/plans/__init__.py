"""lexweave.plans"""
