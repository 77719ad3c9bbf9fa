"""kinveil.plans"""
