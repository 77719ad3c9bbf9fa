"""kinveil.operators"""
